from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from vintara.llm import language, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def test_held_out_accuracy(docs):
    """Text alone, on documents the models were not fitted on."""
    fold = F.pmod(F.xxhash64("text"), F.lit(4))
    model = language.fit(docs.where(fold != 0))
    got = language.identify(docs.where(fold == 0), model, keep=("lang_is",)) if "lang_is" in docs.columns else \
        language.identify(docs.where(fold == 0).withColumnRenamed("lang", "lang_is"), model, keep=("lang_is",))
    rows = got.collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_is and r.kept for r in rows) >= 0.98 * len(rows)


def test_query_rows_and_verdicts(spark, docs):
    got = queries.op6_language(spark, SF).collect()
    langs = {r.doc_id: r.lang for r in docs.collect()}
    by_doc = {r.doc_id: r for r in got if r.doc_id is not None}
    assert set(by_doc) == set(langs) and len(got) == len(langs) + spark.read.parquet(f"{SF}/pages.parquet").count()
    assert sum(by_doc[k].lang == v and by_doc[k].kept for k, v in langs.items()) >= 0.99 * len(langs)
    pages = [r for r in got if r.page_id is not None]
    assert sum(r.lang == r.declared for r in pages) >= 0.99 * len(pages)


def test_noise_is_rejected(spark, model):
    import random
    pick = random.Random(1)
    noise = ["".join(chr(pick.randrange(0x21, 0x2FF)) for _ in range(400)) for _ in range(20)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(noise)], "id long, text string")
    got = language.identify(frame, model, keep=("id",)).collect()
    assert not any(r.kept for r in got) and {r.lang for r in got} == {language.NONE}


def test_host_decides_what_the_text_leaves_open(spark, docs, model):
    """The same two letters on a German and a French host."""
    known = docs.where("lang in ('de', 'fr')").select("text", F.concat(F.lit("host-"), "lang").alias("host"))
    short = spark.createDataFrame([("en", "host-de"), ("en", "host-fr"), ("", "host-fr")], "text string, host string")
    got = language.identify(known.union(short).withColumn("mine", F.length("text") < 3), model, host="host", keep=("host", "mine", "text"))
    assert {(r.host, r.text): r.lang for r in got.where("mine").collect()} == {
        ("host-de", "en"): "de", ("host-fr", "en"): "fr", ("host-fr", ""): "fr"}


def test_numbers_by_hand(spark, model):
    """Fusion of all evidence against the formulas, row by row."""
    rows = [("ein der die", "de", "de", "a.de"), ("the and of", "en", "de", "a.de"), ("le la de", None, "fr", "b.fr"), ("", "fr", "fr", "b.fr"),
            (None, None, None, None), ("the the", "en", None, None), ("und", "de", "org", "c.org")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, declared string, suffix string, host string")
    got = {r.id: (r.lang, r.probability) for r in language.identify(
        frame, model, declared="declared", suffix="suffix", host="host", keep=("id",)).collect()}
    k = len(model.classes)
    scores = [model.score((r[0] or "").encode()) for r in rows]
    soft = lambda s: [math.exp(x - max(s)) / sum(math.exp(y - max(s)) for y in s) for x in s]
    alone = [soft(s) for s in scores]
    total = lambda at: [sum(alone[i][c] for i in at) for c in range(k)]
    smooth = lambda n, wider: [(x + language.PRIOR_ROWS * w) / (sum(n) + language.PRIOR_ROWS) for x, w in zip(n, wider)]

    def without(n, i):
        return [max(0.0, x - y) for x, y in zip(n, alone[i])]

    for i, (_, declared, suffix, host) in enumerate(rows):
        prior = smooth(without(total(range(len(rows))), i), [1 / k] * k)
        if suffix:
            by_suffix = smooth(without(total([j for j, r in enumerate(rows) if r[2] == suffix]), i), prior)
        if host:
            prior = smooth(without(total([j for j, r in enumerate(rows) if r[3] == host]), i), by_suffix if suffix else prior)
        logs = [s + math.log(p) for s, p in zip(scores[i], prior)]
        if declared:
            kinds = {r[1] for r in rows if r[1]}
            all_ = total([j for j, r in enumerate(rows) if r[1]])
            mine = total([j for j, r in enumerate(rows) if r[1] == declared])
            logs = [x + math.log((m + 1) / (a + len(kinds) + 1)) for x, m, a in zip(logs, mine, all_)]
        p = soft(logs)
        assert got[i][1] == pytest.approx(max(p)) and got[i][0] == model.classes[p.index(max(p))]


def test_parts_of_pages(spark):
    frame = spark.createDataFrame([("https://u@Blog.Example.DE:80/a?b#c", "<HTML dir=x LANG='de-AT'><script>x</script><p>Hallo</p><!-- y -->"),
                                   ("nothing", "<p>text"), (None, None)], "url string, html string")
    host = language.host(F.col("url"))
    got = frame.select(host.alias("h"), language.suffix(host).alias("s"), language.declared_in(F.col("html")).alias("d"),
                       F.trim(language.visible(F.col("html"))).alias("t")).collect()
    assert [tuple(r) for r in got] == [("blog.example.de:80", "de", "de", "Hallo"), (None, None, None, "text"), (None,) * 4]


def test_odd_rows(spark, model):
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "the and of the", "h"), (3, "le la les des " * 20_000, "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string").withColumn("s", F.lit("x")).withColumn("_p", F.lit(1))
    got = language.identify(frame, model, host="host", keep=("doc_id", "s", "_p"))
    assert got.count() == 5 and {r.s for r in got.collect()} == {"x"}
    assert language.identify(frame.limit(0), model, host="host", keep=("doc_id",)).count() == 0


def _languages(spark, n, each):
    """``each`` documents in each of ``n`` made-up languages, whose words share no letters' order."""
    import random
    pick, rows = random.Random(7), []
    for i in range(n):
        words = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randrange(2, 8))) for _ in range(60)]
        rows += [(100_000 + i * each + j, " ".join(pick.choice(words) for _ in range(150)), f"X{i:02}") for j in range(each)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_language_has_a_model(spark, docs):
    """More languages than 32, each with less than a hundredth of the texts."""
    more = _languages(spark, 45, 3)
    every = docs.select("doc_id", "text", "lang").union(more)
    model = language.fit(every)
    assert model.languages == sorted(["de", "en", "es", "fr", *[f"x{i:02}" for i in range(45)]])
    got = {r.doc_id: r for r in language.identify(every, model, declared="lang", keep=("doc_id",)).collect()}
    assert all(got[r.doc_id].kept and got[r.doc_id].lang == r.lang.lower() for r in more.collect())
    assert sum(got[r.doc_id].kept and got[r.doc_id].lang == r.lang for r in docs.collect()) >= 0.98 * docs.count()


def test_a_language_too_rare_for_one_draw(spark, docs):
    """One document among more others than a model is fitted on; its texts are the lowest hashes of its own language."""
    rare = _languages(spark, 1, 1)
    model = language.fit(docs.select("doc_id", "text", "lang").union(rare), sample=1)
    assert model.languages == ["de", "en", "es", "fr", "x00"]


def test_lowest_hashes_of_each_language(spark):
    import random
    pick = random.Random(3)
    rows = [("abc"[i % 3] if i % 50 else "d", pick.randrange(-2**63, 2**63)) for i in range(3000)]
    rows += [("e", -2**63), ("e", 2**63 - 1), ("e", 0)]
    got = sorted(tuple(r) for r in language._lowest(spark.createDataFrame(rows, "lang string, h long"), 100).select("lang", "h").collect())
    assert got == sorted((k, h) for k in "abcde" for h in sorted(h for x, h in rows if x == k)[:100])


def test_declared_without_a_model_is_undecided(spark, model):
    import random
    pick = random.Random(1)
    noise = "".join(chr(pick.randrange(0x21, 0x2FF)) for _ in range(400))
    rows = [(0, noise, "Xx"), (1, noise, "en"), (2, noise, None), (3, "the house by the river was old and the door was open", "xx")]
    frame = spark.createDataFrame(rows, "id long, text string, declared string")
    got = {r.id: (r.lang, r.kept) for r in language.identify(frame, model, declared="declared", keep=("id",)).collect()}
    assert got == {0: (None, True), 1: (language.NONE, False), 2: (language.NONE, False), 3: ("en", True)}
