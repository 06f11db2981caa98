"""The operators as registered queries over the given tables, and their SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, conversation_repair, embedding_dedup, langid, lm_scoring, mixing, near_dedup, packing, periodic_runs, quality_model,
    quality_rules, secret_scan, warc,
)
from .common import read, remainder, text_of, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _sql_words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws}))


@query(f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
w as materialized (select rid, doc_id, t, {_sql_words('t')} words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) lines from d),
g as (select rid, i, list_slice(words, i, i + 4) g from (select rid, words, unnest(generate_series(1, len(words) - 4)) i from w)),
r as (select rid, i from (select rid, i, count(*) over (partition by rid, g) n from g) where n > 1),
c as (select rid, count(distinct p) n from (select rid, i + unnest([0, 1, 2, 3, 4]) p from r) group by rid),
m as (select doc_id, len(words) n_words, length(array_to_string(words, '')) word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) n_symbols, len(lines) - len(list_distinct(lines)) n_dup_lines,
  coalesce(c.n, 0) n_repeat_words, len(lines) n_lines, len(list_filter(words, lambda w: lower(w) in ({_STOPS}))) stops,
  len(list_filter(words, lambda w: ends_with(w, '!!'))) bangs from w left join c using (rid))
select doc_id, cast(n_words as bigint) n_words, cast(word_chars as bigint) word_chars, cast(n_symbols as bigint) n_symbols,
  cast(n_dup_lines as bigint) n_dup_lines, cast(n_repeat_words as bigint) n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_symbols <= 0.25 * n_words and bangs <= 0.25 * n_words
  and word_chars between 1.5 * n_words and 25 * n_words and n_dup_lines <= 0.5 * n_lines and stops <= 0.9 * n_words
  and (n_words < 100 or stops >= 0.005 * n_words) kept from m
""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    judged = quality_rules.judged(docs)
    return judged.select("doc_id", *(F.col(f"{quality_rules.OUT}.{n}").alias(n) for n in names))


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized(read(spark, sf_dir, "documents"), ranked=True)
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(slim).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.decisions(mixing.numbered(read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


# The payload's SHA-1 in base32: five hexadecimal digits at a time make four characters.
_BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
    "((cast('0x' || substr(h, 1 + 5 * (i // 4), 5) as integer) >> (15 - 5 * (i % 4))) & 31), 1)), '')"
)


@query(f"""
with p as (select page_id, coalesce(html, '') html from pages),
h as (select page_id, octet_length(encode(html)) n, sha1(html) h, min(page_id) over (partition by html) f from p)
select page_id, cast(n as bigint) payload_bytes, {_BASE32} payload_digest,
  case when page_id = f then 'response' else 'revisit' end record_type, case when page_id <> f then f end refers_to from h
""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    sound = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat_ws(": ", "path", "problem"))).otherwise(F.col("page_id"))
    return records.select(sound.cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


def _sql_escaped(text: str) -> str:
    text = f"regexp_replace({text}, '{chat.CONTROL}', '<\\\\\\1\\2>', 'g')"
    return f"regexp_replace({text}, '{chat.CONTROL_SQUARE}', '[\\\\\\1\\2]', 'g')"


@query(f"""
with c as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations union all
  select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t as (select *, lag(role) over (partition by conv_id order by turn, role, text) is distinct from role as new_run from c)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256,
  cast(sum(length({_sql_escaped('text')}) + case when new_run then
    length({_sql_escaped('role')}) + {len(chat.TURN + chat.TEXT + chat.END)} else {len(chat.PART)} end) as bigint) formatted_chars
from t group by conv_id
""")
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    mark = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", mark), (-1, 1, "assistant", mark)], turns.schema)
    return chat.digests(chat.formatted(turns.unionByName(probe)))


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(read(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda n: F.col(f"{secret_scan.OUT}.{n}")
    return found.select("doc_id", of("n_assign"), of("n_access"), of("n_hex"), F.sha2(of("base"), 256).alias("base_sha256"), of("spans"))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    known = langid.profiles(docs.filter(~held_out).select("lang", "text"))
    found = langid.predicted(docs.select("doc_id", "text"), known)
    return found.select("doc_id", held_out.alias("held_out"), F.col(f"{langid.OUT}.lang_pred").alias("lang_pred"), F.col(f"{langid.OUT}.score").alias("score"))


@query()
def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    found = quality_model.scored(docs, quality_model.trained(docs, labels))
    return found.select("doc_id", held_out.alias("held_out"), F.col(f"{quality_model.OUT}.score").alias("score"), F.col(f"{quality_model.OUT}.predicted").alias("predicted"))


@query("""
with recursive e as materialized (select vec_id, embedding::double[] v from embeddings),
l as materialized (select a.vec_id x, b.vec_id y from e a join e b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.9),
c(x, r) as (select vec_id, vec_id from e union select l.y, c.r from c join l using (x)),
m as (select x, min(r) r from c group by x)
select vec_id, (select count(*) from l where l.x = vec_id) n_links, r component_id, vec_id = r kept from e join m on m.x = e.vec_id
""")
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query()
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def _sql_crc32(text: str) -> str:
    """crc32 of a text of ASCII characters: each one enters the register, then eight shifts (-1) follow."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "lambda r, b: case when b >= 0 then xor(r, b) else xor(r >> 1, 3988292384 * (r & 1)) end"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {steps}::bigint[]), {step}), 4294967295::bigint)"


def damaged_words(docs: DataFrame) -> DataFrame:
    """doc_id and text, the words of some texts repeated from a place on, both chosen by the id (null: the empty text)."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # a generator keeps the words from being worked out at each use
    held = docs.select("doc_id", text_of().alias("text"), number.alias("h"), F.explode(F.array(F.when(number % 10 == 0, words_of(text_of())))).alias("w"))
    n, g = F.size("w"), F.expr("h div 10")
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", start + 1, period), F.ceil((n - start) / period).cast("int"))), F.lit(1), n - start)
    return held.select("doc_id", F.when(n > 0, F.array_join(F.concat(F.slice("w", F.lit(1), start), tail), " ")).otherwise(F.col("text")).alias("text"))


@query(f"""
with d as (select row_number() over () rid, doc_id, {_sql_words("coalesce(text, '')")} w, {_sql_crc32("doc_id::varchar")} h from documents),
a as (select *, case when len(w) > 0 then (h // 10) % len(w) end a from d),
p as (select *, 1 + (len(w) - a) // (3 + (h // 10) % 8) p from a),
t as materialized (select rid, doc_id, case when h % 10 = 0 and len(w) > 0
  then list_concat(list_slice(w, 1, a), list_transform(range(a, len(w)), lambda i: w[1 + a + (i - a) % p])) else w end w from p),
g as (select rid, i, list_slice(w, i + 1, i + 6) g from (select rid, w, unnest(range(0, len(w) - 5)) i from t)),
l as (select x.rid, x.i, y.i - x.i q from g x join g y on x.rid = y.rid and x.g = y.g and y.i > x.i),
s as (select rid, q, i - row_number() over (partition by rid, q order by i) k, i from l),
m as (select rid, q, min(i) b, count(*) + 5 n from s group by rid, q, k having count(*) + 5 >= greatest(12 - q, q)),
r as materialized (select rid, b, n + q n, min(q) q from m group by rid, b, n + q),
o as (select rid, count(*) n_runs, first(b order by n desc, b, q) b, first(n order by n desc, b, q) n, first(q order by n desc, b, q) q,
  string_agg(b || ',' || n || ',' || q || chr(10), '' order by b, q) runs from r group by rid),
x as (select distinct rid, unnest(range(b + q, b + n)) i from r),
c as (select rid, string_agg(w, ' ' order by i) t from (select rid, unnest(w) w, unnest(range(0, len(w))) i from t)
  anti join x using (rid, i) group by rid)
select doc_id, coalesce(n_runs, 0) n_runs, o.b "start", o.n "length", o.q period, 1000 * o.n // o.q exponent_milli,
  sha256(coalesce(runs, '')) runs_sha256, sha256(coalesce(c.t, '')) collapsed_sha256
from t left join o using (rid) left join c using (rid)
""")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.judged(damaged_words(read(spark, sf_dir, "documents")))
    runs = F.col(f"{periodic_runs.OUT}.runs")
    best = periodic_runs.longest(runs)
    lines = F.array_join(F.transform(runs, lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.floor(1000 * best.length / best.period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col(f"{periodic_runs.OUT}.collapsed"), 256).alias("collapsed_sha256"),
    )


def damaged_turns(turns: DataFrame) -> DataFrame:
    """conversations with some rows dropped, emptied, cut, repeated or given to the user, chosen by conv_id and turn; nulls are blanks."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    left = turns.filter(fate != 0)
    times = F.explode(F.array_repeat(F.lit(1), F.when(fate == 3, 2).otherwise(1)))
    return left.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), times.alias("time")).drop("time")


_CLOSURE = "(0,0,0,''),(0,2,2,'I'),(0,3,4,'II'),(1,1,0,''),(1,2,2,'I'),(1,3,4,'II'),(2,2,0,''),(2,3,2,'I'),(3,3,0,''),(3,2,2,'I')"


@query(f"""
with recursive a as (select conv_id, turn, coalesce(role, ' ') r, coalesce(text, ' ') t,
  {_sql_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 f from conversations),
b as (select conv_id, turn, case f when 4 then 'user' else r end r, case f when 1 then '' when 2 then regexp_replace(t, '[.!?]', '', 'g') else t end t,
  unnest(range(case f when 3 then 2 else 1 end)) from a where f <> 0),
c as (select *, row_number() over (partition by conv_id order by turn nulls first, r, md5(t)) i from b),
d as (select *, row_number() over (partition by conv_id, r, t order by i) n, regexp_matches(t, '[^\x20\x09-\x0D]') word,
  regexp_matches(t, '[.!?][\x20\x09-\x0D]*$') closed, lag(left(r, 1)) over (partition by conv_id order by i) p from c),
rows as materialized (select conv_id, turn, i, r, t, not word blank, word and n > 1 dup, word and n = 1 and not closed cut,
  i > 1 and p || left(r, 1) not in ('su', 'ua', 'au') bad from d),
steps as (select * from (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(p, x, q)),
more as (select * from (values {_CLOSURE}) v(p, q, cost, audit)),
edits as materialized (
  select conv_id, i, s p, s q, 3 cost, 'D' audit from rows, (values (0), (1), (2), (3)) v(s)
  union all select conv_id, i, p, q, cut::int, 'K' from rows join steps on x = left(r, 1) where not blank and not dup
  union all select conv_id, i, p, q, 2 + cut::int, 'R' from rows, steps where x <> 's' and not blank and not dup),
v as (select distinct conv_id, 0::bigint i, q s, cost::bigint cost, audit from rows, more where p = 0
  union all select conv_id, i, s, cost, audit from (
    select v.conv_id, e.i, m.q s, v.cost + e.cost + m.cost cost, v.audit || e.audit || m.audit audit,
      row_number() over (partition by v.conv_id, m.q order by v.cost + e.cost + m.cost, v.audit || e.audit || m.audit) k
    from v join edits e on e.conv_id is not distinct from v.conv_id and e.i = v.i + 1 and e.p = v.s join more m on m.p = e.q) where k = 1),
g as (select conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (blank) blank,
  count(*) filter (dup) dup, count(*) filter (cut) cut, count(*) filter (bad) bad from rows group by conv_id),
best as (select g.conv_id, first(v.cost order by v.cost, v.audit) cost, first(v.audit order by v.cost, v.audit) audit
  from g join v on v.conv_id is not distinct from g.conv_id and v.i = g.n and v.s in (0, 3) group by g.conv_id),
e as (select conv_id, unnest(string_split(audit, '')) x, unnest(range(1, len(audit) + 1)) k from best),
f as (select *, sum((x <> 'I')::int) over w i, sum((x <> 'D')::int) over w o from e where x <> '' window w as (partition by conv_id order by k)),
h as (select f.conv_id, k, x, o, r, t, bool_or(x = 'K' and o = 1 and left(r, 1) = 's') over (partition by f.conv_id) sys
  from f left join rows on rows.conv_id is not distinct from f.conv_id and rows.i = f.i),
s as (select conv_id, string_agg(case x when 'K' then r else case when (o + sys::int) % 2 = 1 then 'user' else 'assistant' end end || ':' ||
  case x when 'I' then '' else t end, chr(10) order by k) t from h where x <> 'D' group by conv_id)
select z.conv_id, cast(coalesce(gaps, 0) as bigint) gaps, coalesce(blank, 0) blank, coalesce(dup, 0) "duplicate", coalesce(cut, 0) truncated,
  coalesce(bad, 0) illegal, coalesce(best.cost, 0) "cost", coalesce(best.audit, '') audit, sha256(coalesce(s.t, '')) repaired_sha256
from (select distinct conv_id from conversations) z left join g on g.conv_id is not distinct from z.conv_id
  left join best on best.conv_id is not distinct from z.conv_id left join s on s.conv_id is not distinct from z.conv_id
""")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    turns = damaged_turns(conversations)
    return conversation_repair.for_all(conversations, conversation_repair.digests(turns, conversation_repair.plans(turns)))


@query()
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.scored(read(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) != 2)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
