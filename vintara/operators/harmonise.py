"""Map releases with drifting headers onto one canonical layout.

Resolution looks at column *names* only and happens on the driver; the rows are touched
by a single projection. Data matter in one case: an entirely empty column must not shadow
a filled one that maps to the same target. Only those contested targets are counted, once
per file, and everything else needs no extra pass.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.functions.text import normalise_header_text, quoted
from vintara.operators.joins import lookup_join


def _keep_all(_: str) -> bool:
    return False


@dataclass(frozen=True)
class Layout:
    """Canonical columns and how release headers reach them.

    ``policy`` decides when several columns of one file map to the same target:
    ``first`` takes the first physical column that is not entirely empty, ``coalesce``
    the first non-null value of each row, ``copy_drop`` replays the alias table literally
    (each alias copied onto its target and dropped, so the last source wins and a name
    aliased to itself is lost). ``fallbacks`` fill nulls of a target from other columns.
    """

    columns: Sequence[str]
    aliases: Mapping[str, str] = field(default_factory=dict)
    drop: Callable[[str], bool] = _keep_all
    policy: str = "first"
    fallbacks: Mapping[str, Sequence[str]] = field(default_factory=dict)
    normalise: Callable[[str], str] = normalise_header_text


def usable_columns(header: Sequence[str], layout: Layout) -> dict[str, int]:
    """Normalised name -> position: first of each name, unnamed and dropped ones left out."""
    found: dict[str, int] = {}
    for position, text in enumerate(header):
        name = layout.normalise(text)
        if name and name not in found and not layout.drop(name):
            found[name] = position
    return found


def _replay(names: Iterable[str], aliases: Mapping[str, str]) -> dict[str, str]:
    """Target -> source name after copying and dropping each alias in table order."""
    live = {name: name for name in names}
    for old, new in aliases.items():
        if old in live:
            live[new] = live[old]
            live.pop(old)
    return live


def candidates(header: Sequence[str], layout: Layout) -> dict[str, list[int]]:
    """Target column -> positions of the source columns, in order of preference."""
    found = usable_columns(header, layout)
    wanted = set(layout.columns)
    targets: dict[str, list[int]] = {}
    if layout.policy == "copy_drop":
        for target, source in _replay(found, layout.aliases).items():
            if target in wanted:
                targets[target] = [found[source]]
        return targets
    for name, position in found.items():
        target = layout.aliases.get(name, name)
        if target in wanted:
            targets.setdefault(target, []).append(position)
    return targets


def contested_columns(header: Sequence[str], layout: Layout) -> list[str]:
    """Columns of which several map to one target and the first that is not empty counts."""
    if layout.policy != "first":
        return []
    return [header[p] for p in sorted({p for ps in candidates(header, layout).values() if len(ps) > 1 for p in ps})]


def _filled(position: int) -> str:
    return f"filled_{position}"


def _choose(options: list[int], layout: Layout, is_filled: Mapping[int, Column]) -> Column:
    columns = [F.col(f"_{p}").cast("string") for p in options]
    if len(columns) == 1:
        return columns[0]
    if layout.policy == "coalesce":
        return F.coalesce(*columns)
    return reduce(
        lambda chain, pair: chain.when(is_filled[pair[0]], pair[1]),
        list(zip(options, columns))[1:],
        F.when(is_filled[options[0]], columns[0]),
    )


def harmonise(
    df: DataFrame,
    layout: Layout,
    lineage: Mapping[str, Column] | None = None,
    keep: Sequence[str] = (),
    file: str | None = None,
    filled: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Project a release onto the canonical columns, all nullable strings.

    ``keep`` names columns passed through untouched after the canonical ones (positions,
    file names); they take no part in mapping. ``lineage`` gives canonical columns computed
    from kept columns. ``file`` names the kept column that tells the files of ``df`` apart;
    without it ``df`` is one file. ``filled`` says in which files contested columns hold values,
    if that is known; otherwise they are counted in a pass of their own.
    """
    lineage = dict(lineage or {})
    names = df.columns
    kept = [i for i, name in enumerate(names) if name in keep]
    data = [i for i in range(len(names)) if i not in kept]
    # positional names: headers may repeat, differ in case only, or contain dots
    flat = df.toDF(*[names[i] if i in kept else f"_{i}" for i in range(len(names))])
    options = {
        target: [data[p] for p in positions]
        for target, positions in candidates([names[i] for i in data], layout).items()
        if target not in lineage
    }
    contested = sorted({p for ps in options.values() if len(ps) > 1 for p in ps})
    is_filled: dict[int, Column] = {}
    if contested and layout.policy == "first" and filled is not None:
        is_filled = {p: F.col(file).isin(list(filled.get(names[p], ()))) for p in contested}
    elif contested and layout.policy == "first":
        counts = [F.max(F.col(f"_{p}").isNotNull()).alias(_filled(p)) for p in contested]
        if file is None:
            profile = flat.agg(F.struct(*counts)).scalar()
            is_filled = {p: profile.getField(_filled(p)) for p in contested}
        else:
            per_file = flat.groupBy(F.col(file).alias("_file")).agg(*counts)
            # a small profile is broadcast at run time, by its measured size
            flat = lookup_join(flat, per_file.withColumnRenamed("_file", file), [file])
            is_filled = {p: F.col(_filled(p)) for p in contested}

    missing = F.lit(None).cast("string")
    chosen = {t: _choose(ps, layout, is_filled) for t, ps in options.items()}
    chosen |= {t: c.cast("string") for t, c in lineage.items()}
    for target, others in layout.fallbacks.items():
        parts = [chosen[t] for t in (target, *others) if t in chosen]
        if parts:
            chosen[target] = F.coalesce(*parts)
    return flat.select(
        *[chosen.get(t, missing).alias(t) for t in layout.columns],
        *[F.col(quoted(names[i])) for i in kept if names[i] not in layout.columns],
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; columns a frame lacks become null."""
    if not frames:
        raise ValueError("no releases to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---- headers as data: all files' headers are one table (year, pos, name) ----


def resolve_header(
    header: Sequence[str], mapping: Mapping[str, str], targets: Sequence[str], ignored: Sequence[str] = ()
) -> dict[str, str]:
    """Target -> column of one file's header: the first column that maps to a known target."""
    found: dict[str, str] = {}
    for name in header:
        target = mapping.get(name)
        if name not in ignored and target in targets:
            found.setdefault(target, name)
    return found


def resolve_headers(
    headers: DataFrame,
    mapping: Mapping[str, str],
    targets: Sequence[str],
    ignored: Mapping[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Header rows with their target and what becomes of them.

    ``headers(year, pos, name)``; the mapping (original -> final), the target names and the
    ignored names by year are tables of a few hundred entries, literals of the plan.
    ``outcome`` is ``mapped``, ``duplicate`` (an earlier column of the file has the target),
    ``no_target`` or ``unmapped``; ignored headers are left out. Only headers with a known
    target meet their file's first one, by an aggregate and a join.
    """
    skipped = reduce(lambda a, b: a | b, [
        (F.col("year") == year) & F.col("name").isin(list(names)) for year, names in (ignored or {}).items()], F.lit(False))
    table = F.from_json(F.lit(json.dumps(dict(mapping))), "map<string,string>")
    known = F.coalesce(F.col("target").isin(list(targets)), F.lit(False))
    linked = headers.where(~F.coalesce(skipped, F.lit(False))).select(
        "year", "pos", "name", F.try_element_at(table, F.col("name")).alias("target"))
    first = linked.where(known).groupBy("year", "target").agg(F.min("pos").alias("first_pos"))
    placed = lookup_join(linked.where(known), first, ["year", "target"]).select(
        "year", "pos", "name", "target",
        F.when(F.col("pos") == F.col("first_pos"), "mapped").otherwise("duplicate").alias("outcome"))
    return placed.unionByName(linked.where(~known).withColumn(
        "outcome", F.when(F.col("target").isNull(), "unmapped").otherwise("no_target")))


def unmapped_report(resolved: DataFrame) -> DataFrame:
    """Column name and the years it could not be mapped in, by name."""
    years = F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ", ")
    return (
        resolved.where(F.col("outcome").isin("unmapped", "no_target"))
        .groupBy(F.col("name").alias("column_name"))
        .agg(years.alias("years_appeared"))
        .orderBy("column_name")
    )


def empty_columns(df: DataFrame, file: str) -> DataFrame:
    """(file, column) pairs that hold no value in that file."""
    data = [c for c in df.columns if c != file]
    counts = df.groupBy(file).agg(*[F.count(F.col(quoted(c))).alias(c) for c in data])
    return (
        counts.unpivot([file], data, "column_name", "filled")
        .where("filled = 0")
        .select(F.col(file), "column_name")
    )
