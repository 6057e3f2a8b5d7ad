"""Links of a page with what encloses them: nearest block, headings above, table row.

Elements nest by name: a closing tag ends the last open element of its name and everything open
inside that one, and is ignored where none is open; elements never closed reach to the end of the
page. A page is an array of tags and texts, and one running state over it (``scans``) holds the open
elements. Everything happens inside the row, without Python and without a shuffle.

What an element says matters only as far as the rules look for phrases in it: an open element
carries a bit for each phrase its text has had so far, and hands them to the element around it when
it ends. So no text is put together, and a page costs time by its length, however deep elements nest.
An open element also knows what a link inside would find: its nearest block, its row and that row's
number of cells before it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.config.sites import DEPRECATED_TEXTS, EXTENSIONS, LAYOUT_TEXTS, PROGRAM_KEYS
from vintara.functions.text import bind, strip
from vintara.operators.markup import href_of, unescape
from vintara.operators.scans import all_text, held, lines, put_out, running

BLOCKS = ("td", "p", "li", "div")
HEADINGS = ("h2", "h3", "h4", "strong", "b")
#: Elements without content, which nothing closes.
EMPTY = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

#: What the rules look for in texts, in lower case, a bit each.
PHRASES = [*PROGRAM_KEYS, *DEPRECATED_TEXTS, *LAYOUT_TEXTS, "annual", "report"]
#: Characters of a text in which a phrase may begin or end that other texts continue.
_EDGE = max(map(len, PHRASES))
#: Two characters that follow each other in a phrase.
_PAIRS = sorted({p[i:i + 2] for p in PHRASES for i in range(len(p) - 1)})
_ANY = "|".join(re.escape(p) for p in sorted(PHRASES, key=len, reverse=True))

#: Open elements that are held in one array; more are put aside, as text, that many at a time.
_DEPTH = 48
#: Comments, declarations and bogus closing tags are no part of a page; scripts and styles end a text.
_NOTHING = r"(?s)<!--.*?-->|<[!?][^>]*>|</[^a-zA-Z][^>]*>"
_SCRIPT = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>"
#: A tag and the text after it: slash and name, attributes, text.
_TOKEN = r"""(?s)(?:<(/?[a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\z)|^)((?:[^<]++|<(?!/?[a-zA-Z]))*+)"""

#: What an open element knows: its number if it matters, texts and characters before it, and what a
#: link inside finds: block, row around (``tr``, its cells before it ``base``, cells open in it
#: ``tds``, the row a first cell of it belongs to ``alt``), the row it belongs to.
_FIELDS = ["name", "id", "kind", "first", "start", "block", "tables", "tr", "base", "alt", "alt_base", "tds", "row", "row_base"]
_ELEMENT = "struct<name:string," + ",".join(f"{f}:int" for f in _FIELDS[1:]) + ">"
_ACROSS = "array<struct<at:int,mask:bigint>>"
#: Open elements and their phrases; those put aside and their names; counts; the end of the text so
#: far; phrases over several texts that began before the innermost element.
_STATE = {"top": f"array<{_ELEMENT}>", "masks": "array<bigint>", "under": "binary", "deep": "array<string>", "ids": "int", "trs": "int",
          "cells": "int", "pieces": "int", "length": "int", "tail": "string", "across": _ACROSS, "out": "binary"}
_NOW = "struct<" + ",".join(f"{n}:{k}" for n, k in _STATE.items()) + ">"
_ENDS = "struct<mask:bigint,out:binary>"
_OPENS, _CLOSES, _TEXT, _LINK, _LEAF = 1, 2, 3, 4, 5


def _int(n: int) -> Column:
    return F.lit(n).cast("int")


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _with(state: Column, **new: Column) -> Column:
    """The state with some fields replaced."""
    return F.struct(*[new.get(n, state[n]).alias(n) for n in _STATE])


def _bits(text: Column) -> Column:
    """A bit for each phrase in a text."""
    each = reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(text.contains(p), _long(1 << i)).otherwise(_long(0)) for i, p in enumerate(PHRASES)])
    return F.when(text.rlike(_ANY), each).otherwise(_long(0))


def _program(mask: Column) -> Column:
    """Program of the first key among the phrases."""
    return F.coalesce(*[F.when(mask.bitwiseAND(_long(1 << i)) != 0, F.lit(program))
                        for i, program in enumerate(PROGRAM_KEYS.values())])


def _said(mask: Column, phrase: str) -> Column:
    return mask.bitwiseAND(_long(1 << PHRASES.index(phrase))) != 0


# ---- tokens ----


def tokens(html: Column, extensions: Sequence[str]) -> Column:
    """Tags and the texts after them, in order: kind, name, of links href and whether it names a
    file, of texts the text in lower case and its bits."""
    page = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _NOTHING, ""), _SCRIPT, "<wbr>"), _NOTHING, "")
    no_href, no = F.lit(None).cast("string"), F.lit(False)

    def token(kind: int, name: Column, href: Column = no_href, file: Column = no, text: Column = F.lit(""), mask: Column = _long(0)) -> Column:
        return F.struct(_int(kind).alias("kind"), name.alias("name"), href.alias("href"), file.alias("file"), text.alias("text"), mask.alias("mask"))

    def tag_tokens(name: Column, inner: Column) -> Column:
        link = bind(href_of(inner), lambda h: token(_OPENS, F.lit("a"), h, F.coalesce(
            h.rlike(r"(?i)\.(" + "|".join(extensions) + r")\z"), no)))
        begin = F.when(name == "a", link).otherwise(token(_OPENS, name))
        alone = inner.endswith("/") & inner.rlike(r"""(?s)(?:^|[\s"'])/$""")
        return F.when(name.isin("", *EMPTY), F.array().cast(F_TOKENS)).when(
            name.startswith("/"), F.array(token(_CLOSES, F.substring(name, 2, 1000)))).when(
            alone, F.array(begin, token(_CLOSES, name))).otherwise(F.array(begin))

    def text_tokens(text: Column) -> Column:
        some = bind(F.lower(strip(unescape(text))), lambda t: F.when(t == "", F.array().cast(F_TOKENS)).otherwise(
            F.array(token(_TEXT, F.lit(""), text=t, mask=_bits(t)))))
        return F.when(text.isin("", "\n", " "), F.array().cast(F_TOKENS)).otherwise(some)

    def of(t: Column) -> Column:
        return F.concat(tag_tokens(t["name"], t["inner"]), text_tokens(t["text"]))

    def groups(p: Column) -> Column:
        name, inner, text = (F.regexp_extract_all(p, F.lit(_TOKEN), i) for i in (1, 2, 3))
        return F.arrays_zip(F.transform(name, F.lower).alias("name"), inner.alias("inner"), text.alias("text"))

    zipped = bind(page, groups)
    return bind(F.flatten(F.transform(zipped, of)), _leaves)


def _leaves(found: Column) -> Column:
    """An element with nothing but a text inside is one token if it matters; of others the text stays."""
    def two(t: Column, i: Column) -> Column:
        """Where the element that opens here closes, if nothing but a text is between."""
        after, then = F.get(found, i + 1), F.get(found, i + 2)
        closes = lambda x: (x["name"] == t["name"]) & (x["kind"] == _CLOSES)
        return F.when((t["kind"] != _OPENS) | t["name"].isin("tr", "table"), 0).when(closes(after), 1).when(
            closes(then) & (after["kind"] == _TEXT), 2).otherwise(0)

    def kept(sizes: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            size, matters = F.get(sizes, i), t["name"].isin(*BLOCKS, *HEADINGS)
            text = F.get(found, i + 1)
            said = F.when(size == 2, F.struct(text["text"].alias("text"), text["mask"].alias("mask"))).otherwise(
                F.struct(F.lit("").alias("text"), _long(0).alias("mask")))
            own = F.when(matters, _LEAF).otherwise(_LINK)
            leaf = F.struct(own.alias("kind"), t["name"].alias("name"), t["href"].alias("href"), t["file"].alias("file"),
                            F.when(matters, said["text"]).otherwise("").alias("text"), F.when(matters, said["mask"]).otherwise(_long(0)).alias("mask"))
            before, earlier = F.get(sizes, i - 1), F.get(sizes, i - 2)
            inside = (before == 2) & F.get(found, i - 1)["name"].isin(*BLOCKS, *HEADINGS)  # the text of a leaf
            ends = (before == 1) | ((earlier == 2) & (t["kind"] == _CLOSES))
            gone = ends | inside | ((size > 0) & ~matters & t["href"].isNull())
            return F.when(F.coalesce(gone, F.lit(False)), F.lit(None).cast(F_TOKENS[6:-1])).when(size > 0, leaf).otherwise(t)

        return F.filter(F.transform(found, one), lambda t: t.isNotNull())

    return bind(F.transform(found, two), kept)


F_TOKENS = "array<struct<kind:int,name:string,href:string,file:boolean,text:string,mask:bigint>>"


# ---- the state after a token ----


def _opened(s: Column, t: Column, place: Column) -> Column:
    """Put a new element on top; what a link in it finds follows from the one around it."""
    name, e, before, none = t["name"], F.element_at(s["top"], -1), s["cells"], _int(-1)
    heading, block = name.isin(*HEADINGS), name.isin(*BLOCKS)
    known, cell, row = heading | block, name == "td", (name == "tr") & (e["tables"] > 0)
    inner = (e["tds"] >= 1) | (before != e["base"])  # a cell here is not the first of the row around
    outer = (e["tds"] > 0) | (e["base"] != before)  # a first cell of this row is not that of the row around
    in_row = cell & (e["tr"] >= 0)

    def of_row(own: str, other: str) -> Column:
        return F.when(row, F.when(e["tr"] < 0, none).when(outer, e[own]).otherwise(e[other])).otherwise(e[other])

    new = {
        "name": name, "id": F.when(known, s["ids"]).otherwise(none), "kind": F.when(cell, 2).when(heading, 1).otherwise(0),
        "first": s["pieces"], "start": s["length"], "block": F.when(block, s["ids"]).otherwise(e["block"]),
        "tables": F.when(name == "table", e["tables"] + 1).otherwise(e["tables"]),
        "tr": F.when(row, s["trs"]).otherwise(e["tr"]), "base": F.when(row, before).otherwise(e["base"]),
        "alt": of_row("tr", "alt"), "alt_base": of_row("base", "alt_base"),
        "tds": F.when(row, 0).when(cell, e["tds"] + 1).otherwise(e["tds"]),
        "row": F.when(in_row, F.when(inner, e["tr"]).otherwise(e["alt"])).otherwise(e["row"]),
        "row_base": F.when(in_row, F.when(inner, e["base"]).otherwise(e["alt_base"])).otherwise(e["row_base"]),
    }
    element = F.array(F.struct(*[new[f].alias(f) for f in _FIELDS]))
    full = F.size(s["top"]) >= _DEPTH
    aside = F.encode(F.concat(F.to_json(F.struct(s["top"].alias("top"), s["masks"].alias("masks"))), F.lit("\n")), "utf-8")
    named = F.transform(s["top"], lambda x: x["name"])
    link = _found(s, e, place)
    return _with(
        s, top=F.when(full, element).otherwise(F.concat(s["top"], element)),
        masks=F.when(full, F.array(_long(0))).otherwise(F.concat(s["masks"], F.array(_long(0)))),
        under=F.when(full, F.concat(s["under"], aside)).otherwise(s["under"]),
        deep=F.when(full, F.array_union(s["deep"], named)).otherwise(s["deep"]),
        ids=F.when(known, s["ids"] + 1).otherwise(s["ids"]), cells=F.when(cell, before + 1).otherwise(before),
        trs=F.when(row, s["trs"] + 1).otherwise(s["trs"]), out=F.when(t["href"].isNotNull(), link).otherwise(s["out"]))


def _or(across: Column, start: Column) -> Column:
    """Phrases over several texts that began where an element was open already."""
    return F.when(F.size(across) == 0, _long(0)).otherwise(F.aggregate(
        F.filter(across, lambda p: p["at"] >= start), _long(0), lambda a, p: a.bitwiseOR(p["mask"])))


def _ended(out: Column, e: Column, mask: Column, pieces: Column) -> Column:
    return F.when(e["id"] < 0, out).otherwise(put_out(out, _int(0), e["id"], mask, e["kind"], e["first"], pieces))


def _innermost(s: Column) -> Column:
    """End the innermost element, of at least two on top; its phrases go to the one around it."""
    n, e, around = F.size(s["top"]), F.element_at(s["top"], -1), F.element_at(s["top"], -2)
    mask = F.element_at(s["masks"], -1).bitwiseOR(_or(s["across"], e["start"]))
    merged = F.element_at(s["masks"], -2).bitwiseOR(mask).bitwiseOR(_or(s["across"], around["start"]))
    return _with(
        s, top=F.slice(s["top"], 1, n - 1), masks=F.concat(F.slice(s["masks"], 1, n - 2), F.array(merged)),
        across=F.when(F.size(s["across"]) == 0, s["across"]).otherwise(F.filter(s["across"], lambda p: p["at"] < around["start"])),
        out=_ended(s["out"], e, mask, s["pieces"]))


def _chunks(under: Column) -> Column:
    """What was put aside, parsed."""
    text = F.filter(F.split(F.decode(under, "utf-8"), "\n"), lambda c: c != "")
    return F.transform(text, lambda c: F.from_json(c, f"struct<top:array<{_ELEMENT}>,masks:array<bigint>>"))


def _several(s: Column, name: Column) -> Column:
    """End the last open element of a name with all inside, wherever it is."""
    def of(every: Column) -> Column:
        holds = F.transform(every, lambda c: F.exists(c["top"], lambda e: e["name"] == name))
        return held(F.size(every) - F.array_position(F.reverse(holds), True).cast("int") + 1, lambda k: cut(every, k), _NOW)

    def cut(every: Column, k: Column) -> Column:
        chunk = F.element_at(every, k)
        keep = F.size(chunk["top"]) - F.array_position(F.reverse(F.transform(chunk["top"], lambda e: e["name"])), name).cast("int")
        later = F.slice(every, k + 1, F.size(every))

        def split(keep: Column) -> Column:
            rest = F.size(chunk["top"])
            gone = F.concat(F.slice(chunk["top"], keep + 1, rest), F.flatten(F.transform(later, lambda c: c["top"])))
            masks = F.concat(F.slice(chunk["masks"], keep + 1, rest), F.flatten(F.transform(later, lambda c: c["masks"])))
            before = F.slice(every, 1, k - 1)
            # where nothing is left of a chunk, the one before it comes back
            empty = keep == 0
            left = F.when(empty, F.element_at(every, k - 1)).otherwise(F.struct(
                F.slice(chunk["top"], 1, keep).alias("top"), F.slice(chunk["masks"], 1, keep).alias("masks")))
            aside = F.when(empty, F.slice(every, 1, k - 2)).otherwise(before)
            popped = F.reverse(F.arrays_zip(gone.alias("e"), masks.alias("mask")))
            return held(F.struct(left.alias("left"), aside.alias("aside"), running(popped, {"mask": _long(0)}, end, _ENDS).alias("ends")),
                        struck, _NOW)

        return held(keep, split, _NOW)

    def end(a: Column, x: Column) -> Column:
        mask = a["mask"].bitwiseOR(x["mask"]).bitwiseOR(_or(s["across"], x["e"]["start"]))
        return F.struct(mask.alias("mask"), _ended(a["out"], x["e"], mask, s["pieces"]).alias("out"))

    def struck(r: Column) -> Column:
        top, masks = r["left"]["top"], r["left"]["masks"]
        last = F.element_at(top, -1)
        merged = F.element_at(masks, -1).bitwiseOR(r["ends"]["state"]["mask"]).bitwiseOR(_or(s["across"], last["start"]))
        text = F.array_join(F.transform(r["aside"], lambda c: F.concat(F.to_json(c), F.lit("\n"))), "")
        return _with(
            s, top=top, masks=F.concat(F.slice(masks, 1, F.size(masks) - 1), F.array(merged)), under=F.encode(text, "utf-8"),
            deep=F.array_distinct(F.flatten(F.transform(r["aside"], lambda c: F.transform(c["top"], lambda e: e["name"])))),
            across=F.filter(s["across"], lambda p: p["at"] < last["start"]),
            out=F.concat(s["out"], F.encode(all_text(r["ends"]["outs"]), "utf-8")))

    own = F.struct(s["top"].alias("top"), s["masks"].alias("masks"))
    return held(F.concat(_chunks(s["under"]), F.array(own)), of, _NOW)


def _closed(s: Column, t: Column) -> Column:
    name = t["name"]
    open_here = F.exists(s["top"], lambda e: e["name"] == name)
    return F.when((F.element_at(s["top"], -1)["name"] == name) & (F.size(s["top"]) > 1), _innermost(s)).when(
        open_here | F.array_contains(s["deep"], name), _several(s, name)).otherwise(s)


def _read(s: Column, t: Column) -> Column:
    """The state after a text: its phrases, and those that earlier texts began."""
    text, last, n = t["text"], F.element_at(s["top"], -1), F.size(s["masks"])

    def one(i: int, phrase: str) -> Column:
        """A phrase across the edge, with where it begins; it occurs there once at most."""
        size = len(phrase) - 1
        before = F.right(s["tail"], F.lit(size))
        at = F.locate(phrase, F.concat(before, F.substring(text, 1, size)))
        return F.struct((s["length"] - F.length(before) + at - 1).alias("at"), F.when(at > 0, _long(1 << i)).otherwise(_long(0)).alias("mask"))

    def added(across: Column) -> Column:
        mask = F.element_at(s["masks"], -1).bitwiseOR(t["mask"]).bitwiseOR(_or(across, last["start"]))
        return _with(after, masks=F.concat(F.slice(s["masks"], 1, n - 1), F.array(mask)),
                     across=F.concat(s["across"], F.filter(across, lambda p: p["at"] < last["start"])))

    after = _with(s, pieces=s["pieces"] + 1, length=s["length"] + F.length(text), tail=F.right(
        F.concat(s["tail"], F.right(text, F.lit(_EDGE))), F.lit(_EDGE)))
    pair = F.concat(F.right(s["tail"], F.lit(1)), F.substring(text, 1, 1))
    begun = pair.isin(_PAIRS) & F.concat(s["tail"], F.substring(text, 1, _EDGE)).rlike(_ANY)
    found = F.filter(F.array(*[one(i, p) for i, p in enumerate(PHRASES)]), lambda p: p["mask"] != 0)
    with_mask = _with(after, masks=F.concat(F.slice(s["masks"], 1, n - 1), F.array(F.element_at(s["masks"], -1).bitwiseOR(t["mask"]))))
    return F.when(begun, held(found, added, _NOW)).when(t["mask"] != 0, with_mask).otherwise(after)


def _found(s: Column, e: Column, place: Column) -> Column:
    """Put out a link that stands in an element."""
    return put_out(s["out"], _int(1), e["row"], place, e["row_base"], e["block"], s["ids"])


def _leaf(s: Column, t: Column) -> Column:
    """An element with a text or nothing inside: begun, read and ended at once."""
    kind = F.when(t["name"] == "td", 2).when(t["name"].isin(*HEADINGS), 1).otherwise(0)
    read = F.when(t["text"] == "", s["pieces"]).otherwise(s["pieces"] + 1)
    return _with(s, ids=s["ids"] + 1, cells=F.when(kind == 2, s["cells"] + 1).otherwise(s["cells"]),
                 out=put_out(s["out"], _int(0), s["ids"], t["mask"], kind, s["pieces"], read))


def _step(s: Column, x: Column) -> Column:
    t, kind = x["t"], x["t"]["kind"]
    return F.when(kind == _OPENS, _opened(s, t, x["place"])).when(kind == _CLOSES, _closed(s, t)).when(kind == _TEXT, _read(s, t)).when(
        kind == _LINK, _with(s, out=_found(s, F.element_at(s["top"], -1), x["place"]))).when(
        t["text"] == "", _leaf(s, t)).otherwise(held(_leaf(s, t), lambda after: _read(after, t), _NOW))


def _start() -> dict[str, Column]:
    """The page itself, whose end closes all, in an element that nothing closes."""
    def element(name: str) -> Column:
        own = {"name": F.lit(name)} | dict.fromkeys(("start", "first", "tables", "tds", "kind"), _int(0))
        return F.struct(*[own.get(f, _int(-1)).alias(f) for f in _FIELDS])

    return {"top": F.array(element("//"), element("/")).cast(f"array<{_ELEMENT}>"), "masks": F.array(_long(0), _long(0)),
            "under": F.expr("cast('' as binary)"), "deep": F.array().cast("array<string>"), "tail": F.lit(""),
            "across": F.array().cast(_ACROSS), **dict.fromkeys(("ids", "trs", "cells", "pieces", "length"), _int(0))}


# ---- links ----


def _numbered(links: Column) -> Column:
    """Links of rows in order of row, with their number in the row."""
    def step(s: Column, x: Column) -> Column:
        nth = F.when(x[0] == s["row"], s["nth"] + 1).otherwise(0)
        return F.struct(x[0].alias("row"), nth.cast("bigint").alias("nth"), put_out(s["out"], *[x[i] for i in range(5)], nth).alias("out"))

    zero = {"row": _long(-1), "nth": _long(0)}
    return lines(all_text(running(F.array_sort(links), zero, step, "struct<row:bigint,nth:bigint,out:binary>")["outs"]))


def _announced(ended: Column) -> Column:
    """By number of elements begun: which of them is the last heading that announces a program, or -1."""
    def step(s: Column, e: Column) -> Column:
        says = (e[2] == 1) & ~_said(e[1], "annual") & (e[1].bitwiseAND(_long((1 << len(PROGRAM_KEYS)) - 1)) != 0)
        last = F.when(says, e[0]).otherwise(s["last"])
        return F.struct(last.alias("last"), put_out(s["out"], last).alias("out"))

    return F.transform(lines(all_text(running(ended, {"last": _long(-1)}, step, "struct<last:bigint,out:binary>")["outs"])), lambda x: x[0])


def page_links(html: Column, extensions: Sequence[str]) -> Column:
    """Links to files of one page: pos, href, programs of ``block`` and ``heading``, row, nth, cell."""
    def read(found: Column) -> Column:
        end = F.struct(_int(_CLOSES).alias("kind"), F.lit("/").alias("name"), F.lit(None).cast("string").alias("href"),
                       F.lit(False).alias("file"), F.lit("").alias("text"), _long(0).alias("mask"))
        items = F.transform(F.concat(found, F.array(end)), lambda t, i: F.struct(t.alias("t"), i.alias("place")))
        said = lines(all_text(running(items, _start(), _step, _NOW)["outs"]))
        return bind(said, lambda x: sorted_out(found, x))

    def sorted_out(found: Column, said: Column) -> Column:
        def rest(kind: int) -> Column:
            return F.transform(F.filter(said, lambda x: x[0] == kind), lambda x: F.slice(x, 2, 5))

        links = rest(1)
        in_rows = _numbered(F.filter(links, lambda x: x[0] >= 0))
        others = F.transform(F.filter(links, lambda x: x[0] < 0), lambda x: F.concat(x, F.array(_long(-1))))
        files = F.filter(F.concat(in_rows, others), lambda x: F.get(found, x[1].cast("int"))["file"])
        texts = F.filter(F.transform(found, lambda t: t["text"]), lambda t: t != "")
        return bind(F.struct(F.array_sort(rest(0)).alias("ended"), files.alias("files"), texts.alias("texts")), placed_in(found))

    def placed_in(found: Column):
        def of(r: Column) -> Column:
            by = F.struct(_announced(r["ended"]).alias("heading"), F.filter(r["ended"], lambda e: e[2] == 2).alias("cells"))
            return bind(by, lambda b: F.transform(r["files"], lambda x: one(found, r, b, x)))

        return of

    def one(found: Column, r: Column, by: Column, x: Column) -> Column:
        at = lambda c: c.cast("int")
        row, heading = x[0] >= 0, F.get(by["heading"], at(x[4]) - 1)
        return F.struct(
            at(x[1]).alias("pos"), F.get(found, at(x[1]))["href"].alias("href"),
            F.when(x[3] >= 0, _program(F.get(r["ended"], at(x[3]))[1])).alias("block"),
            F.when((x[4] > 0) & (heading >= 0), _program(F.get(r["ended"], at(heading))[1])).alias("heading"),
            F.when(row, at(x[0])).alias("row"), F.when(row, at(x[5])).alias("nth"),
            F.when(row, _cell(r["texts"], F.get(by["cells"], at(x[2])))).alias("cell"))

    return bind(tokens(html, extensions), read)


def _cell(texts: Column, cell: Column) -> Column:
    """What a cell says as far as the rules look: its beginning, and the phrases further on."""
    first, size = cell[3].cast("int"), (cell[4] - cell[3]).cast("int")
    head = F.array_join(F.slice(texts, first + 1, F.least(size, F.lit(_EDGE + 1))), "")
    later = F.array_join(F.array(*[F.when(_said(cell[1], p), F.lit(p)) for p in PHRASES]), "\n")
    return F.when(size == 0, "").when((size <= _EDGE) & (F.length(head) <= 4 * _EDGE), head).otherwise(
        F.concat(F.substring(head, 1, _EDGE), F.lit("\n"), later))


@lru_cache
def _links_in(application: str, extensions: tuple[str, ...]) -> Column:
    """The expression over ``html``, put together once per session."""
    return page_links(F.col("html"), extensions)


def placed_links(pages: DataFrame, kind: str = "disclosure") -> DataFrame:
    """Each link to a file of ``pages(page_id, url, html)`` with its place: ``pos``; the program that
    its nearest ``block`` and the last announcing ``heading`` before it name; ``row``, ``nth`` and
    first ``cell`` of the table row in whose later cells it stands, if any.

    Of a long cell ``cell`` has the beginning and the phrases that the rules look for, in lower case.
    Pages that can hold no such link, however it is written, are not read.
    """
    extensions = EXTENSIONS[kind]
    some = pages.where(F.col("html").rlike(r"(?i)\.(" + "|".join(extensions) + r")|&#|&period;"))
    # outer: a plain explode would have the page read again to infer a non-empty filter
    found = _links_in(pages.sparkSession.sparkContext.applicationId, tuple(extensions))
    return some.select("page_id", F.col("url").alias("base"), F.explode_outer(found).alias("l")).where(
        "l IS NOT NULL").select("page_id", "base", "l.*")
