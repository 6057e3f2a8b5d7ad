"""License scans: ordered signature rules over the words of a text.

A text is lower-cased (A-Z), cut into words and put on one line, so that a signature is a regular
expression over words whatever stood between them. A rule has a label, a priority, a confidence and
a keyword; its expression is only tried on texts in which the keyword occurs. Of overlapping
detections, one that lies within another of higher priority, or within a longer one of the same, is
suppressed.

Rules are hand-written families; a family's versions and forms (name, short name, identifier, link)
make the single rules, some hundreds. Texts are scanned where they are, without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara.llm import common

common.by_value(__name__)

#: Phrases whose places count on their own, and their labels (fixed by the contract).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Rule(NamedTuple):
    label: str
    pattern: str
    keyword: str
    priority: int
    confidence: float


class Family(NamedTuple):
    """``name`` and ``short`` are expressions before the version, ``link`` one with ``{}`` for it."""

    label: str
    keyword: str
    name: str
    short: str | None
    link: str | None
    versions: tuple[str, ...]
    #: Word that identifies the family in links, if the keyword need not be there.
    link_keyword: str | None = None


LICENSE = r"licen[sc]es?"

FAMILIES = (
    Family("apache", "apache", rf"apache (?:software )?{LICENSE}", "apache", r"apache org licenses license {}", ("1.0", "1.1", "2.0")),
    Family("gpl", "general", rf"(?:gnu )?general public {LICENSE}", None, r"gnu org licenses (?:old licenses )?gpl {}", ("1.0", "2.0", "3.0"), "gpl"),
    Family("gpl", "gpl", r"(?:gnu )?gpl(?: licen[sc]e)?", None, None, ("1.0", "2.0", "3.0")),
    Family("lgpl", "lesser", rf"(?:gnu )?lesser general public {LICENSE}", None, r"gnu org licenses (?:old licenses )?lgpl {}", ("2.1", "3.0"), "lgpl"),
    Family("lgpl", "library", rf"(?:gnu )?library general public {LICENSE}", None, None, ("2.0",)),
    Family("lgpl", "lgpl", r"(?:gnu )?lgpl", None, None, ("2.0", "2.1", "3.0")),
    Family("agpl", "affero", rf"(?:gnu )?affero general public {LICENSE}", None, r"gnu org licenses agpl {}", ("1.0", "3.0"), "agpl"),
    Family("agpl", "agpl", r"(?:gnu )?agpl", None, None, ("1.0", "3.0")),
    Family("gfdl", "documentation", rf"(?:gnu )?free documentation {LICENSE}", None, r"gnu org licenses (?:old licenses )?fdl {}", ("1.1", "1.2", "1.3"), "fdl"),
    Family("mpl", "mozilla", rf"mozilla public {LICENSE}", None, r"mozilla org (?:en us )?mpl {}", ("1.0", "1.1", "2.0")),
    Family("mpl", "mpl", r"mpl", None, None, ("1.0", "1.1", "2.0")),
    Family("epl", "eclipse", rf"eclipse public {LICENSE}", None, r"eclipse org legal epl v?{}", ("1.0", "2.0")),
    Family("cddl", "distribution", rf"common development and distribution {LICENSE}", None, r"opensource org licenses cddl {}", ("1.0", "1.1"), "cddl"),
    Family("cddl", "cddl", r"cddl", None, None, ("1.0", "1.1")),
    Family("cpl", "common", rf"common public {LICENSE}", None, r"opensource org licenses cpl {}", ("1.0",), "cpl"),
    Family("eupl", "european", rf"european union public {LICENSE}", None, None, ("1.0", "1.1", "1.2")),
    Family("eupl", "eupl", r"eupl", None, None, ("1.0", "1.1", "1.2")),
    Family("artistic", "artistic", rf"(?:the )?artistic {LICENSE}", None, r"opensource org licenses artistic {}", ("1.0", "2.0")),
    Family("osl", "open", rf"open software {LICENSE}", None, r"opensource org licenses osl {}", ("1.0", "2.0", "2.1", "3.0"), "osl"),
    Family("afl", "academic", rf"academic free {LICENSE}", None, r"opensource org licenses afl {}", ("1.1", "2.0", "2.1", "3.0"), "afl"),
    Family("bsl", "boost", rf"boost software {LICENSE}", None, r"boost org license {}", ("1.0",)),
    Family("busl", "business", rf"business source {LICENSE}", None, None, ("1.0", "1.1")),
    Family("sspl", "server", rf"server side public {LICENSE}", None, None, ("1.0",)),
    Family("ofl", "sil", rf"sil open font {LICENSE}", None, None, ("1.0", "1.1")),
    Family("lppl", "latex", rf"latex project public {LICENSE}", None, r"latex project org lppl {}", ("1.0", "1.1", "1.2", "1.3")),
    Family("zpl", "zope", rf"zope public {LICENSE}", None, None, ("1.1", "2.0", "2.1")),
    Family("php", "php", rf"(?:the )?php {LICENSE}", None, r"php net license {}", ("2.02", "3.0", "3.01")),
    Family("psf", "python", rf"python software foundation {LICENSE}", None, None, ("2.0",)),
    Family("ecl", "educational", rf"educational community {LICENSE}", None, r"opensource org licenses ecl {}", ("1.0", "2.0"), "ecl"),
    Family("ms-pl", "microsoft", rf"microsoft public {LICENSE}", None, None, ("1.0",)),
    Family("odbl", "database", rf"open database {LICENSE}", None, r"opendatacommons org licenses odbl {}", ("1.0",), "odbl"),
    Family("odc-by", "commons", rf"open data commons attribution {LICENSE}", None, r"opendatacommons org licenses by {}", ("1.0",), "opendatacommons"),
    Family("cc0", "cc0", r"(?:creative commons )?cc0(?: universal)?", None, None, ("1.0",)),
    Family("cc0", "zero", r"creative commons zero", None, r"creativecommons org publicdomain zero {}", ("1.0",)),
)

#: Creative Commons: words of the short and long forms of each kind.
CREATIVE_COMMONS = {
    "cc-by": ("by", "attribution"),
    "cc-by-sa": ("by sa", "attribution share ?alike"),
    "cc-by-nd": ("by nd", "attribution no ?derivs|attribution no ?derivatives"),
    "cc-by-nc": ("by nc", "attribution non ?commercial"),
    "cc-by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
    "cc-by-nc-nd": ("by nc nd", "attribution non ?commercial no ?derivs|attribution non ?commercial no ?derivatives"),
}
CREATIVE_COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: Licenses without versions, and sentences that only stand in notices.
SENTENCES = (
    Rule("mit", rf"(?:the )?(?:mit|expat|x11) {LICENSE}", "licen", 3, 0.9),
    Rule("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby", 6, 0.95),
    Rule("mit", r"spdx license identifier mit", "spdx", 8, 0.99),
    Rule("mit", r"opensource org licenses mit", "opensource", 7, 0.95),
    Rule("isc", rf"(?:the )?isc {LICENSE}", "isc", 3, 0.9),
    Rule("isc", r"permission to use copy modify and or distribute this software for any purpose", "purpose", 6, 0.95),
    Rule("isc", r"spdx license identifier isc", "spdx", 8, 0.99),
    Rule("bsd", rf"(?:the )?bsd(?: style| type)? {LICENSE}", "bsd", 2, 0.85),
    Rule("bsd", r"redistribution and use in source and binary forms with or without modification", "redistribution", 5, 0.9),
    Rule("bsd-2-clause", rf"(?:2|two) clause bsd(?: {LICENSE})?|bsd (?:2|two) clause|simplified bsd {LICENSE}|freebsd {LICENSE}", "bsd", 4, 0.95),
    Rule("bsd-3-clause", rf"(?:3|three) clause bsd(?: {LICENSE})?|bsd (?:3|three) clause|(?:new|modified|revised) bsd {LICENSE}", "bsd", 4, 0.95),
    Rule("bsd-4-clause", rf"(?:4|four) clause bsd(?: {LICENSE})?|bsd (?:4|four) clause|original bsd {LICENSE}", "bsd", 4, 0.95),
    Rule("bsd-0-clause", r"0bsd|(?:zero|0) clause bsd|bsd (?:zero|0) clause", "bsd", 4, 0.95),
    Rule("zlib", rf"(?:zlib|libpng|zlib libpng) {LICENSE}", "lib", 3, 0.9),
    Rule("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty", 6, 0.9),
    Rule("unlicense", r"(?:the )?unlicense", "unlicense", 3, 0.9),
    Rule("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 6, 0.95),
    Rule("wtfpl", rf"wtfpl|do what the fuck you want to public {LICENSE}", "w", 3, 0.9),
    Rule("beerware", rf"beer ?ware {LICENSE}", "beer", 3, 0.9),
    Rule("json", r"the software shall be used for good not evil", "evil", 6, 0.95),
    Rule("openssl", rf"openssl {LICENSE}", "openssl", 3, 0.9),
    Rule("openssl", r"this product includes software developed by the openssl project", "openssl", 6, 0.9),
    Rule("ruby", rf"ruby {LICENSE}", "ruby", 3, 0.8),
    Rule("perl", r"under the same terms as perl(?: itself)?", "perl", 4, 0.85),
    Rule("curl", rf"curl {LICENSE}", "curl", 3, 0.8),
    Rule("vim", rf"vim {LICENSE}", "vim", 3, 0.8),
    Rule("ncsa", rf"(?:university of illinois )?ncsa (?:open source )?{LICENSE}", "ncsa", 3, 0.9),
    Rule("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose", "documentation", 6, 0.9),
    Rule("postgresql", rf"postgresql {LICENSE}", "postgresql", 3, 0.9),
    Rule("upl", rf"universal permissive {LICENSE}", "permissive", 3, 0.9),
    Rule("commons-clause", r"commons clause(?: license condition)?", "clause", 4, 0.9),
    Rule("elastic", rf"elastic {LICENSE}", "elastic", 3, 0.9),
    Rule("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute", 6, 0.95),
    Rule("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "redistribute", 7, 0.95),
    Rule("apache", r"licensed to the apache software foundation asf under one or more contributor license agreements", "contributor", 6, 0.95),
    Rule("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 7, 0.98),
    Rule("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain", 4, 0.9),
    Rule("public-domain", r"(?:is|are) in the public domain|public domain (?:dedication|mark|work)", "domain", 3, 0.8),
    Rule("reserved", r"all rights (?:are )?reserved", "reserved", 3, 0.9),
    Rule("reserved", r"tous droits reserves|tous droits réservés|alle rechte vorbehalten|todos los derechos reservados", "s", 3, 0.9),
    Rule("reserved", r"no part of this (?:publication|book|work|document) may be reproduced", "reproduced", 5, 0.95),
    Rule("proprietary", r"proprietary and confidential|confidential and proprietary", "proprietary", 5, 0.9),
    Rule("proprietary", r"unauthori[sz]ed (?:copying|use|reproduction|distribution) (?:of this (?:file|document|software) )?(?:via any medium )?is (?:strictly )?prohibited", "prohibited", 5, 0.9),
    Rule("no-derivatives", r"may not be (?:copied|reproduced|redistributed) without (?:the )?(?:prior |express |written )*(?:permission|consent)", "without", 4, 0.85),
    Rule("copyright", r"copyright(?: c)?(?: by)? (?:19|20)\d\d(?: (?:19|20)\d\d)?", "copyright", 1, 0.6),
    Rule("copyright", r"(?:copyright )?© ?(?:19|20)\d\d(?: (?:19|20)\d\d)?", "©", 1, 0.6),
    Rule("copyright", r"copyright (?:c )?(?:holders?|owners?)", "copyright", 1, 0.5),
    Rule("licensed", r"(?:is |are )?licensed under(?: the| a)?", "licensed", 0, 0.3),
)


def _number(version: str) -> str:
    """Words of a version; a trailing ``.0`` may be left out."""
    head, _, tail = version.partition(".")
    return rf"{head} {tail}" if tail != "0" else rf"{head}(?: 0)?"


#: What is worked out once per process. A plain dictionary: functions with a cache of their own
#: would be sent to the tasks by name, and executors need not have this package.
_KNOWN: dict = {}


def rules() -> tuple[Rule, ...]:
    """All rules, those of higher priority first."""
    if "rules" not in _KNOWN:
        _KNOWN["rules"] = _all_rules()
    return _KNOWN["rules"]


def _all_rules() -> tuple[Rule, ...]:
    out = list(SENTENCES)
    for f in FAMILIES:
        out.append(Rule(f.label, f.name, f.keyword, 1, 0.7))
        for v in f.versions:
            n, label = _number(v), f"{f.label}-{v}"
            out.append(Rule(label, rf"{f.name}(?: as published by the free software foundation(?: either)?)? (?:version |v ?)?{n}(?: only)?", f.keyword, 4, 0.95))
            out.append(Rule(f"{label}+", rf"{f.name} (?:version |v ?)?{n}(?: or| and) (?:at your option )?(?:any )?later(?: version)?", f.keyword, 5, 0.95))
            out.append(Rule(label, rf"spdx license identifier {f.label.replace('-', ' ')} {v.replace('.', ' ')}(?: only)?", "spdx", 8, 0.99))
            out.append(Rule(f"{label}+", rf"spdx license identifier {f.label.replace('-', ' ')} {v.replace('.', ' ')} or later", "spdx", 9, 0.99))
            if f.short:
                out.append(Rule(label, rf"{f.short} (?:v ?)?{n}", f.keyword, 3, 0.85))
            if f.link:
                out.append(Rule(label, f.link.format(n), f.link_keyword or f.keyword, 7, 0.95))
    for label, (short, long) in CREATIVE_COMMONS.items():
        out.append(Rule(label, rf"(?:creative commons|cc) {short}", "c", 2, 0.85))
        out.append(Rule(label, rf"creative commons (?:{long})(?: {LICENSE})?", "creative", 3, 0.9))
        for v in CREATIVE_COMMONS_VERSIONS:
            n = _number(v)
            out.append(Rule(f"{label}-{v}", rf"(?:creative commons|cc) {short} (?:v ?)?{n}(?: international| unported)?", "c", 4, 0.97))
            out.append(Rule(f"{label}-{v}", rf"creative commons (?:{long})(?: {LICENSE})? (?:version |v ?)?{n}(?: international| unported)?", "creative", 5, 0.97))
            out.append(Rule(f"{label}-{v}", rf"creativecommons org licenses {short} {n}", "creativecommons", 7, 0.98))
            out.append(Rule(f"{label}-{v}", rf"spdx license identifier cc {short} {n}", "spdx", 8, 0.99))
    return tuple(sorted(dict.fromkeys(out), key=lambda r: -r.priority))


def _compiled() -> dict[bytes, list[tuple[Rule, re.Pattern]]]:
    if "compiled" not in _KNOWN:
        _KNOWN["compiled"] = _by_keyword()
    return _KNOWN["compiled"]


def _by_keyword() -> dict[bytes, list[tuple[Rule, re.Pattern]]]:
    """Rules by keyword. Keywords of fewer than three letters gate nothing by themselves: their
    rules wait for what the rule's own words need."""
    gates = {"c": ("creative commons", " cc "), "s": (" droits ", " rechte ", " derechos "), "w": ("wtfpl", " fuck ")}
    by: dict[bytes, list[tuple[Rule, re.Pattern]]] = {}
    for rule in rules():
        pattern = re.compile(rb"(?<= )(?:" + rule.pattern.encode() + rb")(?= )")
        for keyword in gates.get(rule.keyword, (rule.keyword,)):
            by.setdefault(keyword.encode(), []).append((rule, pattern))
    return by


_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32
               for c in range(256))


class Detection(NamedTuple):
    first: int
    last: int
    rule: Rule


def suppressed(found: list[Detection]) -> list[Detection]:
    """Without detections that lie in one of higher priority or in a longer one of the same;
    of equal ones the first label stays."""
    order = sorted(set(found), key=lambda d: (-d.rule.priority, d.first - d.last, d.first, d.rule.label))
    kept: list[Detection] = []
    firsts: list[int] = []  # of the kept ones that lie in no other, with their ends: both ascend
    lasts: list[int] = []
    for d in order:
        at = bisect_right(firsts, d.first)
        if at and lasts[at - 1] >= d.last:
            continue
        kept.append(d)
        begin = at - 1 if at and firsts[at - 1] == d.first else at
        end = bisect_right(lasts, d.last, begin)
        firsts[begin:end], lasts[begin:end] = [d.first], [d.last]
    return sorted(kept, key=lambda d: (d.first, d.last, d.rule.label))


def words_of(text: bytes) -> bytes:
    """The text's words in lower case, one blank around each."""
    return b" " + b" ".join(text.translate(_TABLE).split()) + b" "


def scan_text(text: bytes) -> dict:
    line = words_of(text)
    n_words = line.count(b" ") - 1 if len(line) > 2 else 0
    places: list[tuple[int, str]] = []
    found: dict[tuple[int, int, Rule], None] = {}

    blanks: list[int] = []

    def word(at: int) -> int:
        if not blanks:
            blanks.extend(np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist())
        return bisect_left(blanks, at) - 1

    for phrase, label in BASE.items():
        wanted, at = f" {phrase} ".encode(), line.find(f" {phrase} ".encode())
        while at >= 0:
            places.append((word(at + 1), label))
            at = line.find(wanted, at + 1)
    for keyword, some in _compiled().items():
        if keyword in line:
            for rule, pattern in some:
                for m in pattern.finditer(line):
                    first = word(m.start())
                    found[first, first + m[0].strip().count(b" "), rule] = None
    kept = suppressed([Detection(*f) for f in found])
    base = {label for _, label in places}
    doubt = 1.0
    for d in kept:
        doubt *= 1 - d.rule.confidence
    for _ in base:
        doubt *= 0.5
    firsts = [at for at, _ in places]
    return {"n_words": n_words, "n_base": len(places), "first_word": min(firsts, default=None),
            "last_word": max(firsts, default=None), "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {d.rule.label for d in kept})), "score": 1 - doubt,
            "detections": [{"label": d.rule.label, "first": d.first, "last": d.last, "priority": d.rule.priority} for d in kept]}


_TYPE = ("struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:string,labels:string,score:double,"
         "detections:array<struct<label:string,first:long,last:long,priority:int>>>")
_ARROW = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                    ("detections", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                                                       ("priority", pa.int32())])))])


def scan(text: Column) -> Column:
    """What the rules find in a text, as a struct; a null text is empty.

    ``n_words``; the base phrases' ``n_base`` places, ``first_word`` and ``last_word`` (word
    numbers from 0, null without places) and ``base_labels``; ``labels`` of base phrases and of the
    detections that were not suppressed; ``score``, the probability that at least one of them is
    right; ``detections`` with their first and last word.
    """

    @F.arrow_udf(_TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([scan_text(t or b"") for t in texts.cast(pa.binary()).to_pylist()], _ARROW)

    return found(text)
