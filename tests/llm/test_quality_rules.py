import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tickloom.llm import quality_rules as R


def plain(text):
    """The base measures as the contract words them."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_on_random_texts(spark):
    dice = random.Random(6)
    texts = ["".join(dice.choice(["a ", "b ", "c\n", "dé ", "#", "\t", "\n", "a b c d e ", "x\x0b", "\U0001f600 ", "\x1c", "  "]) for _ in range(dice.randint(0, 80))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in R.judged(df).select("doc_id", f"{R.OUT}.*").collect():
        want = plain(texts[r.doc_id])
        assert tuple(r[n] for n in NAMES) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.reasons) and not (r.kept and r.base_failed)


def test_rules_name_what_fails(spark):
    text = "the house of the old man was near the river and it is said that he had many books in all of his rooms"
    rows = {
        "good": text, "few": "one two", "symbols": text.replace(" ", " $ "), "shouting": text.upper().replace(" ", "!! "),
        "letters": " ".join("abcdefghijklmnopqrstuvwxyz0123456789"), "lines": "one of the\n" * 3 + "\n".join(f"{w} and {k}" for k, w in enumerate(text.split()[:2])),
        "foreign": " ".join(f"zq{k}x" for k in range(200)),
    }
    df = spark.createDataFrame(list(rows.items()), "doc_id string, text string")
    got = {r.doc_id: r.reasons for r in R.judged(df).select("doc_id", f"{R.OUT}.reasons").collect()}
    assert got["good"] == [] and "few_words" in got["few"] and got["symbols"] == ["symbols"] and got["shouting"] == ["shouting"]
    assert "word_length" in got["letters"] and got["foreign"] == ["no_stop_words"]
    strict = R.judged(df, (R.Rule("too_long", "n_words", high=20),)).filter("doc_id = 'good'").select(f"{R.OUT}.reasons").first()
    assert strict.reasons == ["too_long"]


def test_odd_rows(odd_docs, no_docs):
    rows = R.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert tuple(r[R.OUT][n] for n in NAMES) == plain(r.text)
    kept = R.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} <= {r.doc_id for r in rows}
    assert R.judged(no_docs).collect() == [] and R.keep_good(no_docs).collect() == []


def test_native(spark, docs):
    plan = R.judged(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|Exchange", plan)


def test_good_documents_stay_and_junk_goes(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = R.judged(docs).join(labels, "doc_id").select("quality", f"{R.OUT}.*").collect()
    assert all(r.kept or r.base_failed for r in rows if r.quality == 1)
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in junk) <= 0.1 * len(junk)
