from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from vintara.llm import lines, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def _want(docs: list[tuple], num: int = 4, den: int = 5) -> dict:
    """Every line against every earlier one."""
    places = sorted(((k is not None, k or 0, i), frozenset(WORD.findall(t)), (k, text))
                    for k, text in set(docs) for i, t in enumerate((text or "").split("\n")) if WORD.search(t))
    out: dict = {doc: [] for _, _, doc in places}
    for at, (place, words, doc) in enumerate(places):
        for other, (earlier, theirs, _) in enumerate(places[:at]):
            if earlier < place:
                shared = len(words & theirs)
                if den * shared >= num * (len(words) + len(theirs) - shared):
                    out[doc].append(place[2])
                    break
    return {doc: sorted(gone) for doc, gone in out.items()}


def _got(frame, docs) -> dict:
    by = {r.h: (r.doc_id, r.text) for r in frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()}
    found = lines.removed_lines(frame).collect()
    return {(r.doc_id, by[r.doc_h][1]): r.removed for r in found}


def _varied(seed: int, groups: int, each: int, most: int) -> list[tuple]:
    """Documents of lines that are edited copies of some, near the threshold."""
    pick = random.Random(seed)
    common, rare = [f"w{i}" for i in range(30)], [f"r{i}" for i in range(4000)]
    rows = []
    for g in range(groups):
        base = [pick.choice(common if pick.random() < 0.5 else rare) for _ in range(pick.randint(1, most))]
        for _ in range(each):
            line = list(base)
            for _ in range(pick.randint(0, max(1, len(line) // 4))):
                line[pick.randrange(len(line))] = pick.choice(rare + common)
            pick.shuffle(line)
            rows.append(" ".join(line))
    pick.shuffle(rows)
    return [(i, "\n".join(rows[j:j + 3])) for i, j in enumerate(range(0, len(rows), 3))]


@pytest.mark.parametrize("seed,groups,each,most", [(1, 30, 6, 25), (2, 4, 60, 40), (3, 3, 40, 250), (4, 60, 4, 6)])
def test_equals_brute_force(spark, seed, groups, each, most):
    docs = _varied(seed, groups, each, most)
    frame = spark.createDataFrame(docs, SCHEMA)
    assert _got(frame, docs) == _want(docs)


def test_large_group_of_near_copies(spark):
    pick = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for i in range(300):
        line = list(base)
        line[pick.randrange(60)] = f"x{i}"
        docs.append((i, " ".join(line)))
    frame = spark.createDataFrame(docs, SCHEMA)
    assert _got(frame, docs) == _want(docs)


def test_close_ones_that_fail_are_joined_again(spark, monkeypatch):
    """With a sketch that tells nothing, the shortcut is often wrong, and the result the same."""
    monkeypatch.setattr(lines, "_sketch", lambda keys, half: F.lit(0).cast("long"))
    docs = _varied(5, 6, 30, 20)
    assert _got(spark.createDataFrame(docs, SCHEMA), docs) == _want(docs)


def test_query_on_a_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.removed for r in queries.op5_line_dedup(spark, sf_dir).collect()}
    assert got == {k: [] for k, _ in docs} | {k: gone for (k, _), gone in _want(docs).items()}


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (2, ""), (3, "a b c\n\n \t\nd e f"), (4, "d e f\nnew words here\na c b"), (5, "a b c"), (5, "a b c"),
            (None, "a b c"), (5, "other text"), (6, "long " + " ".join(f"w{i}" for i in range(20_000)))]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("removed", F.lit("x")).withColumn("_k", F.lit(1))
    assert _got(frame, docs) == _want(docs)
    out = lines.dedup_lines(frame)
    assert out.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, None), (2, ""), (2, ""), (3, "\n \t\nd e f"), (4, "new words here"), (None, "a b c"), (5, "other text"), docs[-1]], key=str)
    assert lines.dedup_lines(frame.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in lines.removed_by_row(frame).collect()) == sorted(str(k) for k, _ in docs)


def test_main_path_is_native(spark):
    plan = queries.op5_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_go_by_shuffle_where_they_are_many(spark, monkeypatch):
    monkeypatch.setattr(lines, "SMALL", 0)
    docs = _varied(7, 10, 6, 25)
    assert _got(spark.createDataFrame(docs, SCHEMA), docs) == _want(docs)


def test_documents_with_very_many_lines_are_not_broadcast(spark, monkeypatch):
    need = spark.range(3).select(F.struct("id").alias("doc"), F.sequence(F.lit(1), F.lit(400)).alias("need"))
    assert lines._few(need) and lines._few(need.limit(0))
    monkeypatch.setattr(lines, "ENTRIES", 1000)
    assert not lines._few(need)
    docs = _varied(7, 10, 6, 25)
    monkeypatch.setattr(lines, "ENTRIES", 0)
    assert _got(spark.createDataFrame(docs, SCHEMA), docs) == _want(docs)


def _family(size: int) -> list[tuple]:
    """Near copies of one line, each with a few words of its own, of which hardly two are close."""
    pick, base, docs = random.Random(11), [f"b{i}" for i in range(60)], []
    for i in range(size):
        line = list(base)
        for at in pick.sample(range(60), 3):
            line[at] = f"x{i}.{at}"
        docs.append((i, " ".join(line)))
    return docs


def test_pairs_of_a_group_do_not_grow_with_its_square(spark, monkeypatch):
    """What is left to meet by word, and what is verified, stay in proportion to the lines."""
    checked, verify = [], lines.verified

    def counted(pairs, sets, threshold):
        checked.append(pairs.count())
        return verify(pairs, sets, threshold)

    monkeypatch.setattr(lines, "verified", counted)
    docs = _family(400)
    frame = spark.createDataFrame(docs, SCHEMA)
    assert _got(frame, docs) == _want(docs)
    assert 0 < sum(checked) < 4 * len(docs)


def _classes_of(spark, docs) -> tuple:
    rows = lines.lines_of(spark.createDataFrame(docs, SCHEMA), "doc_id", "text", lines.THRESHOLD)
    return rows, lines.settle(lines._classes(rows).withColumn("gone", F.lit(False)))


def test_lines_that_share_words_by_chance_are_no_candidates(spark):
    """Long lines of one small vocabulary: all share rare words, only two match, and they meet by one shuffle."""
    pick = random.Random(13)
    words = [f"w{i}" for i in range(1500)]
    docs = [(i, " ".join(pick.sample(words, 88))) for i in range(700)]
    docs.append((700, docs[0][1] + " more"))
    rows, classes = _classes_of(spark, docs)
    found = lines.candidates(classes, lines.THRESHOLD)
    assert 0 < len(found.collect()) < 5  # of 245350 pairs
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]
    # the table of rarity is no large part of the plan, which the driver holds as text several times
    assert len(rows._jdf.queryExecution().toString()) < 2_000_000


def test_shuffle_files_of_finished_steps_go(spark):
    def files() -> set:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "shuffle_" in f}

    before = files()
    settled = lines.settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    own = files() - before
    assert own and settled.count() == 7  # another job: Spark's scheduler may still hold the last one
    lines.tidy(spark)
    until = time.time() + 20
    while own & files() and time.time() < until:
        time.sleep(0.2)
    assert not own & files()


@pytest.mark.parametrize("threshold", [(4, 5), (2, 3), (9, 10), (1, 2), (3, 3)])
def test_equals_brute_force_at_other_thresholds(spark, threshold):
    docs = _varied(21, 20, 6, 14) + [(900, "a b c d\na b c d e\na b c\nf\nf g"), (901, "b a\ne d c b a\nc b\ng f")]
    frame = spark.createDataFrame(docs, SCHEMA)
    by = {r.h: (r.doc_id, r.text) for r in frame.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    got = {by[r.doc_h]: r.removed for r in lines.removed_lines(frame, threshold=threshold).collect()}
    assert got == _want(docs, *threshold)


@pytest.mark.parametrize("threshold", [(4, 5), (2, 3), (9, 10), (1, 2), (3, 5)])
def test_lines_that_match_meet_by_their_first_words(spark, threshold):
    """However the words in which two lines differ lie among those they share."""
    num, den = threshold
    first = {r.n: r.f for r in spark.range(1, 60).select(F.col("id").cast("int").alias("n")).select(
        "n", lines._first_words(F.col("n"), threshold).alias("f")).collect()}
    step, pick = lines._together(threshold), random.Random(3)
    assert step == (2 if threshold in ((4, 5), (9, 10)) else 1)

    def signs(words: list) -> set:
        words = words[:first[len(words)]]
        return {tuple(words[i:i + step]) for i in range(len(words) - step + 1)}

    for n in range(1, 48):
        for m in range(n, min(n * den // num, 58) + 1):
            shared = -(-num * (n + m) // (num + den))
            if shared > n or n + m == 2 * shared:
                continue
            odd = ["a"] * (n - shared) + ["b"] * (m - shared)
            for trial in range(30):
                pick.shuffle(odd)
                if trial % 2:  # as many as can be part shared words from the beginning on
                    order = [x for pair in zip(["s"] * len(odd), odd) for x in pair][:2 * shared] + odd[shared:] + ["s"] * (shared - len(odd))
                else:
                    order = ["s"] * shared + odd
                    pick.shuffle(order)
                words = [f"{kind}{i}" for i, kind in enumerate(order)]
                assert signs([w for w in words if w[0] != "b"]) & signs([w for w in words if w[0] != "a"]), order


def test_words_that_recur_bring_few_lines_together(spark):
    """Each word stands in many lines, hardly two of them alike: what meets, and is sorted, stays small."""
    pick = random.Random(17)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(pick.sample(words, 12))) for i in range(2000)]
    docs.append((2000, docs[0][1] + " more"))
    _, classes = _classes_of(spark, docs)
    met = lines.meeting(classes, lines.THRESHOLD)
    alike = {r.id for r in classes.where("doc_id in (0, 2000)").collect()}
    assert len(alike) == 2 and alike <= {r.id for r in met.collect()}
    assert met.count() < 2500  # of 10005 rows: of single words, all would have company
