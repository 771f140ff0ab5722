"""Column functions on names and texts (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value of the reference: the length of the time-stamp suffix of a
# landed object's stem.
STAMP_SUFFIX_LEN = 15


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def base_name(key) -> Column:
    """last segment of an object key split by '/'."""
    return F.element_at(F.split(_c(key), "/"), -1)


def stem(name) -> Column:
    """text before the first dot."""
    return F.substring_index(_c(name), ".", 1)


def drop_stamp(name, n: int = STAMP_SUFFIX_LEN) -> Column:
    """drop the last ``n`` characters (the time-stamp suffix)."""
    c = _c(name)
    return F.substring(c, 1, F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def landed_file_name(key, n: int = STAMP_SUFFIX_LEN) -> Column:
    """object key to the expected-file name it carries."""
    return drop_stamp(stem(base_name(key)), n)


def is_data_object(name, prefix: str) -> Column:
    """Non-empty base name that is not a metadata object (``prefix``: the deployment's)."""
    c = _c(name)
    return (F.length(c) > 0) & ~c.startswith(prefix)


def last3(name) -> Column:
    """last three characters."""
    return F.substring(_c(name), -3, 3)


def error_second_part(err) -> Column:
    """the second ':'-separated part; whole text when there is no colon."""
    c = _c(err)
    return F.when(F.instr(c, ":") > 0, F.split(c, ":").getItem(1)).otherwise(c)


def error_tail(err) -> Column:
    """everything after the first ':'; else the whole text."""
    c = _c(err)
    pos = F.instr(c, ":")
    return F.when(pos > 0, c.substr(pos + 1, F.length(c))).otherwise(c)


def comma_list(arr) -> Column:
    """list to comma text, sorted for a deterministic message."""
    return F.array_join(F.array_sort(_c(arr)), ",")


def is_no_arg_call(proc) -> Column:
    """procedure names ending ' ();' are calls without arguments. Names
    are compared as they are (R3); this only classifies them."""
    return F.regexp_like(_c(proc), F.lit(r" \(\);$"))
