"""Language identification by Bayesian evidence fusion.

What is known of a row is multiplied: the likelihood of its text, of the language its markup
declares, and of the suffix of its address, given each language, with a prior of its host. Text
models are byte trigrams, one for every language that a row is labelled with, fitted on a bounded
number of its texts. Everything else comes from all rows by grouped aggregation of what their texts alone say: how often a language
is declared as which, which suffixes it lives under, and the languages of each host, smoothed
towards its suffix and that towards all rows. A row's own text is taken out of its host's counts.

A text counts as ``strength`` independent trigrams at most, by its mean over the whole text: trigrams
of a text depend on each other, and without that no other evidence could ever matter. One more
class, of trigrams drawn evenly, stands for what is no language; a row for which it is most
probable, or no language reaches ``least``, is rejected, unless it declares a language that has no
model: nothing here speaks against that, and it stays undecided.

Texts are scored where they are; only counts by host, suffix and declared language move, after
partial aggregation, and a host with a third of all rows is a key of an aggregate and of a join
that skew handling splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintara.llm import common
from vintara.operators.joins import lookup_join
from vintara.session import settle

common.by_value(__name__)

#: Texts that the model of a language is fitted on, at most; trigrams are hashed to this many numbers.
SAMPLE, TRIGRAMS = 1000, 1 << 14
#: Trigrams of a text that count as independent; rows a prior counts for, as the next wider one.
STRENGTH, PRIOR_ROWS = 60.0, 5.0
#: The class of what is no language.
NONE = "und"
_STEP = 1 << 20
#: Log likelihoods looked up at a time, trigrams by classes.
_CELLS = 1 << 23


def _trigrams(text: bytes, step: int = _STEP) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of a text in lower case, a blank around it, some at a time."""
    data = np.frombuffer(b" " + text.lower() + b" ", np.uint8)
    for at in range(0, len(data) - 2, step):
        part = data[at:at + step + 2].astype(np.uint32)
        yield (part[:-2] * np.uint32(0x9E3779B1) ^ part[1:-1] * np.uint32(0x85EBCA77) ^ part[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(18)


def trigram_counts(text: Column) -> Column:
    """(trigram, times) of a text."""

    @F.arrow_udf("array<struct<gram:int,n:long>>")
    def grams(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("gram", pa.int32()), ("n", pa.int64())]))
        for texts in batches:
            out = []
            for t in texts.cast(pa.binary()).to_pylist():
                count = np.zeros(TRIGRAMS, np.int64)
                for part in _trigrams(t or b""):
                    count += np.bincount(part, minlength=TRIGRAMS)
                out.append([{"gram": int(g), "n": int(count[g])} for g in np.flatnonzero(count)])
            yield pa.array(out, kind)

    return grams(text)


class TextModel:
    """Log likelihood of each trigram in each language, the class of none last."""

    def __init__(self, languages: Sequence[str], table: np.ndarray) -> None:
        self.languages, self.table = list(languages), table

    @property
    def classes(self) -> list[str]:
        return [*self.languages, NONE]

    def score(self, text: bytes) -> list[float]:
        """Mean log likelihood by class, times the number of trigrams that count."""
        total, n = np.zeros(self.table.shape[1]), 0
        for part in _trigrams(text, max(1, _CELLS // len(total))):
            total += self.table[part].sum(0, dtype=np.float64)
            n += len(part)
        return (total / max(1, n) * min(n, STRENGTH)).tolist() if text.strip() else [0.0] * len(total)

    def scores(self, text: Column) -> Column:
        """``array<double>`` by class; zeros for a text without anything to go by."""
        model = self

        @F.arrow_udf("array<double>")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield pa.array([model.score(t or b"") for t in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.float64()))

        return scored(text)


def _lowest(texts: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` lowest hashes ``h`` of each ``lang``, one row for each.

    Hashes are counted by the power of two they lie below; of a language only the powers that hold
    its lowest ones, about twice as many at most, are put in order.
    """
    power = F.floor(-F.log2((F.col("h").cast("double") + 2.0 ** 63 + 1024) / 2.0 ** 64))
    texts = texts.withColumn("power", F.greatest(power, F.lit(0)))
    counted = texts.groupBy("lang", "power").agg(F.count("*").alias("n"))
    lower = F.sum("n").over(W.partitionBy("lang").orderBy(F.desc("power"))) - F.col("n")
    least = counted.withColumn("lower", lower).where(F.col("lower") < sample).groupBy("lang").agg(F.min("power").alias("least"))
    near = texts.join(F.broadcast(least), "lang").where("power >= least")  # a row for each language
    place = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    return near.withColumn("place", place).where(F.col("place") <= sample).select("lang", "h")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> TextModel:
    """Trigram models of all languages in ``lang``, each from ``sample`` texts at most.

    The driver gets ``TRIGRAMS`` counts at most of each language, and keeps 64 KB of it.

    The texts are those of a language that hash lowest, the same on every run; copies of a text
    count once. Each language's counts are smoothed by half a trigram of each kind.
    """
    rows = common.tuned(labelled).select(F.col(text).alias("text"), F.lower(lang).alias("lang"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    chosen = _lowest(settle(rows.groupBy("h").agg(F.min("lang").alias("lang"))), sample)
    some = rows.select("h", "text").join(F.broadcast(chosen), "h").groupBy("h", "lang").agg(F.min("text").alias("text"))
    counts = (some.select("lang", F.explode(trigram_counts(F.col("text"))).alias("g")).select("lang", "g.gram", "g.n")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
              .groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("g")).select("lang", "g.gram", "g.n")).toArrow()
    languages = sorted(counts["lang"].to_pylist())
    table = np.empty((TRIGRAMS, len(languages) + 1), np.float32)
    table[:, -1] = -math.log(TRIGRAMS)
    for lang_, gram, n in zip(counts["lang"].to_pylist(), counts["gram"], counts["n"]):
        own = np.full(TRIGRAMS, 0.5)
        own[gram.values.to_numpy()] += n.values.to_numpy()
        table[:, languages.index(lang_)] = np.log(own / own.sum())
    return TextModel(languages, table)


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    return common.let(F.struct(scores.alias("s"), top.alias("m")), lambda v: common.let(
        F.transform(v["s"], lambda x: F.exp(x - v["m"])),
        lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))))


def _sums(rows: DataFrame, by: Sequence[str], k: int, name: str) -> DataFrame:
    """Sum of the text posteriors by class, as an array."""
    sums = rows.groupBy(*by).agg(*[F.sum(F.get("text_p", F.lit(i))).alias(f"_{i}") for i in range(k)])
    return sums.select(*by, F.array(*[F.col(f"_{i}") for i in range(k)]).alias(name))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def _smooth(counts: Column, wider: Column) -> Column:
    """Chances from counts and the chances of a wider group that count for ``PRIOR_ROWS`` rows."""
    return F.transform(counts, lambda x, i: (x + PRIOR_ROWS * F.get(wider, i)) / (_total(counts) + PRIOR_ROWS))


def suffix(host: Column) -> Column:
    """Last label of a host name that has more than one."""
    return F.nullif(F.regexp_extract(host, r"\.([^.:/]+)(?::\d+)?$", 1), F.lit(""))


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))


def declared_in(html: Column) -> Column:
    """Primary language that the html element declares."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)), F.lit(""))


def visible(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def identify(rows: DataFrame, model: TextModel, text: str = "text", declared: str | None = None, suffix: str | None = None,
             host: str | None = None, keep: Sequence[str] = (), least: float = 0.5) -> DataFrame:
    """The columns ``keep`` with ``lang``, ``probability`` and ``kept`` of each row.

    Null evidence, or none named, leaves the rest to decide; a text without anything in it says
    nothing about any class. Rows that share a host with no other have the suffix's prior. An
    undecided row, not to be rejected for a language without a model, is kept with a null ``lang``.
    """
    k, classes = len(model.classes), model.classes
    known = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    scored = common.tuned(rows).select(
        F.struct(*keep).alias("_row") if keep else F.struct(F.lit(None).alias("_none")).alias("_row"),
        known(declared).alias("declared"), known(suffix).alias("suffix"), known(host).alias("host"),
        model.scores(F.col(text)).alias("s"))
    scored = settle(scored.withColumn("text_p", _softmax(F.col("s"))))
    # a number for each class: literals of what follows
    every = [float(x or 0) for x in _sums(scored, [], k, "all_n").first()["all_n"]]
    # chances given each class: of being declared as something, and of living under a suffix
    facts = {}
    for fact in ("declared", "suffix"):
        sums = _sums(scored.where(F.col(fact).isNotNull()), [fact], k, "n")
        *totals, kinds = sums.agg(*[F.sum(F.get("n", F.lit(i))) for i in range(k)], F.count("*")).first()
        of = F.array(*[F.lit((t or 0.0) + kinds + 1) for t in totals])
        ln = F.transform(F.zip_with("n", of, lambda x, y: (x + 1) / y), F.ln)
        facts[fact] = sums.select(fact, ln.alias(f"{fact}_ln"), F.col("n").alias(f"{fact}_n"))
    hosts = _sums(scored.where("host IS NOT NULL"), ["host"], k, "host_n")
    found = lookup_join(lookup_join(lookup_join(scored, facts["declared"].drop("declared_n"), ["declared"]),
                                    facts["suffix"], ["suffix"]), hosts, ["host"])
    found = found.withColumn("all_n", F.array(*[F.lit(x) for x in every]))
    even = F.array(*[F.lit(1.0 / k)] * k)
    # no row vouches for itself: its own text leaves the counts
    own = lambda c: F.transform(F.col(c), lambda x, i: F.greatest(F.lit(0.0), x - F.get("text_p", i)))
    found = found.withColumn("_all", _smooth(own("all_n"), even))
    found = found.withColumn("_suffix", F.when(F.col("suffix_n").isNotNull(), _smooth(own("suffix_n"), F.col("_all"))).otherwise(F.col("_all")))
    found = found.withColumn("_prior", F.when(F.col("host_n").isNotNull(), _smooth(own("host_n"), F.col("_suffix"))).otherwise(F.col("_all")))
    nothing = F.array(*[F.lit(0.0)] * k)
    # a host's prior already holds what its suffix says
    suffix_ln = F.when(F.col("host").isNull(), F.coalesce("suffix_ln", nothing)).otherwise(nothing)
    fused = F.zip_with(F.zip_with(F.zip_with(F.col("s"), F.coalesce("declared_ln", nothing), lambda a, b: a + b),
                                  suffix_ln, lambda a, b: a + b), F.col("_prior"), lambda a, b: a + F.ln(b))
    found = found.withColumn("_p", _softmax(fused))
    best = F.array_max("_p")
    names = F.array(*[F.lit(c) for c in classes])
    out = found.select("_row", F.lower("declared").alias("declared"), F.element_at(names, F.array_position("_p", best).cast("int")).alias("lang"),
                       best.alias("probability"))
    sure = (F.col("lang") != NONE) & (F.col("probability") >= least)
    # declared, and no class that could have been found
    open_ = ~sure & F.coalesce(~F.array_contains(names, F.col("declared")), F.lit(False))
    return out.select(*[F.col(f"_row.{c}").alias(c) for c in keep], F.when(~open_, F.col("lang")).alias("lang"), "probability",
                      (sure | open_).alias("kept"))
