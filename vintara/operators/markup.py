"""Character references and attributes of HTML, as DataFrame expressions."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_ATTRIBUTE = r"""(?s)([^\s"'>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))"""

#: Named character references: those of HTML 4, and the full stop.
_NAMED = json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "period": "."})
_REFERENCE = r"(?=&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});)"


def _character(code: Column) -> Column:
    """The character of a code point; what is none becomes U+FFFD."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def unescape(c: Column) -> Column:
    """Character references resolved, each once: decimal, hexadecimal and named ones."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def piece(p: Column) -> Column:
        reference = F.regexp_extract(p, "^&([#A-Za-z0-9]+);", 1)
        number = F.when(reference.rlike("^#[0-9]{1,7}$"), F.substring(reference, 2, 9).try_cast("long")).when(
            reference.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(reference, 3, 9), 16, 10).try_cast("long"))
        found = F.when(number.isNotNull(), _character(number)).otherwise(F.try_element_at(named, reference))
        return F.when((reference == "") | found.isNull(), p).otherwise(
            F.concat(found, F.substring(p, F.length(reference) + 3, F.length(p))))

    return F.when(c.contains("&"), F.array_join(F.transform(F.split(c, _REFERENCE), piece), "")).otherwise(c)


def href_of(tag: Column) -> Column:
    """Address in the attributes of an opening tag, null without one."""
    attributes = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), 1)
    own = F.get(F.filter(attributes, lambda a: a.rlike(r"(?i)^href\s*=")), F.lit(0))
    value = F.regexp_replace(own, r"^[^=]*=\s*", "")
    return unescape(F.regexp_replace(value, "^[\"']|[\"']\\z", ""))
