"""Running state over an array column, as DataFrame expressions.

Spark copies what a lambda over an array returns, arrays in it element by element; only bytes are
handed on as they are. So a state that is carried over many items should be small, and what the
steps put out is written as text into bytes (``out``), which are parsed once in the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara.functions.text import bind

#: Items after which the text put out so far is set aside.
CHUNK = 128
NO_TEXT = "cast('' as binary)"


def held(value: Column, body: Callable[[Column], Column], kind: str) -> Column:
    """``body(value)``, of type ``kind``, with the value computed once."""
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, v: body(v))


def put_out(out: Column, *numbers: Column) -> Column:
    """The bytes with one more line of numbers."""
    return F.concat(out, F.encode(F.concat(F.concat_ws(",", *[n.cast("string") for n in numbers]), F.lit(";")), "utf-8"))


def all_text(outs: Column) -> Column:
    """The text of several bytes in a row."""
    return F.array_join(F.transform(outs, lambda b: F.decode(b, "utf-8")), "")


def lines(text: Column) -> Column:
    """Lines of numbers that ``put_out`` wrote."""
    return F.transform(F.filter(F.split(text, ";"), lambda x: x != ""), lambda x: F.split(x, ",").cast("array<bigint>"))


def running(items: Column, zero: dict[str, Column], step: Callable[[Column, Column], Column], kind: str) -> Column:
    """``state`` after all items and ``outs``, what the steps put out, in order.

    ``step(state, item)`` gives the next state, a struct of type ``kind`` whose last field is
    ``out``. Time grows with the number of items, not with its square.
    """
    names = [f.split(":")[0] for f in _fields(kind)]

    def begun(state: Column) -> Column:
        return F.struct(*[(F.expr(NO_TEXT) if n == "out" else state[n]).alias(n) for n in names])

    def chunks(all_items: Column) -> Column:
        last = F.floor(F.greatest(F.size(all_items) - 1, F.lit(0)) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_items, i * CHUNK + 1, CHUNK))

    whole = f"struct<state:{kind},outs:array<binary>>"
    start = F.struct(*[(F.expr(NO_TEXT) if n == "out" else zero[n]).alias(n) for n in names])
    return F.aggregate(
        bind(items, chunks), F.struct(start.alias("state"), F.array().cast("array<binary>").alias("outs")),
        lambda acc, chunk: held(F.aggregate(chunk, begun(acc["state"]), step), lambda s: F.struct(
            s.alias("state"), F.concat(acc["outs"], F.array(s["out"])).alias("outs")), whole))


def _fields(kind: str) -> list[str]:
    """Fields of a struct type, those of inner ones not cut apart."""
    out, depth = [""], 0
    for c in kind[len("struct<"):-1]:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out
