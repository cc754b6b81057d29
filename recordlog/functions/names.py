"""Topic-name functions (Column in, Column out)."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DLQ_EXT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def topic_list(col: str | Column) -> Column:
    """``"a, b,c"`` -> ``[a, b, c]``: with a comma, all whitespace goes and every part is kept
    (also empty ones); without a comma the text is one topic, untrimmed."""
    c = _c(col)
    return (F.when(c.contains(","), F.split(F.regexp_replace(c, r"\s+", ""), ",", -1))
            .otherwise(F.array(c)))


def parse_topic_list(text: str) -> list[str]:
    """The same rule for a Python string (arguments of operators)."""
    if "," in text:
        # Java's \s: ASCII whitespace only
        return re.sub(r"[ \t\n\x0b\f\r]+", "", text).split(",")
    return [text]


def dlq_topic(col: str | Column, ext: str = DLQ_EXT, always: bool = False) -> Column:
    """Dead-letter topic of a topic: suffix ``ext`` unless the name already contains it
    (``always=True``: suffix unconditionally)."""
    c = _c(col)
    suffixed = F.concat(c, F.lit(ext))
    return suffixed if always else F.when(c.contains(ext), c).otherwise(suffixed)


def base_topic(col: str | Column, ext: str = DLQ_EXT) -> Column:
    """Text before the first occurrence of ``ext`` (the whole name when absent)."""
    return F.substring_index(_c(col), ext, 1)


def without_suffix(col: str | Column, ext: str = DLQ_EXT) -> Column:
    """The name without ``ext`` at its end; an ``ext`` inside the name stays."""
    c = _c(col)
    return F.when(c.endswith(ext), F.substring(c, F.lit(1), F.length(c) - len(ext))).otherwise(c)


def parse_bool(col: str | Column) -> Column:
    """Only a case-insensitive ``true`` is true; anything else, null included, is false."""
    return F.coalesce(F.lower(_c(col)) == F.lit("true"), F.lit(False))


def is_empty(col: str | Column) -> Column:
    return F.coalesce(_c(col), F.lit("")) == F.lit("")


def nonempty(col: str | Column) -> Column:
    """The value, or null when it is null or empty."""
    c = _c(col)
    return F.when(c != F.lit(""), c)


def topic_in(col: str | Column, configured: str | list[str], mode: str = "strict") -> Column:
    """Membership of a topic in the configured topics.

    ``strict``: exact member of the parsed list; ``compat``: substring of the configured
    comma text (so "test" matches "test1", as the original service does)."""
    c = _c(col)
    if mode == "compat":
        text = configured if isinstance(configured, str) else ",".join(configured)
        return F.coalesce(F.instr(F.lit(text), c) > 0, F.lit(False))
    topics = parse_topic_list(configured) if isinstance(configured, str) else list(configured)
    return F.coalesce(c.isin(topics), F.lit(False))


def name_uuid(name: Column, namespace: str = "6ba7b811-9dad-11d1-80b4-00c04fd430c8") -> Column:
    """UUID of a name (version 5, RFC 9562) in a namespace, the URL one by default: the same for the same name, so
    a retry repeats it.  ``F.uuid()`` gives random ones."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
                       F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
