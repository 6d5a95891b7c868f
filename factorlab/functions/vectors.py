"""Vector expressions on ``array<double>`` columns, evaluated inside the JVM.

All of these are higher-order functions (``zip_with``, ``aggregate``, ``transform``), which
Spark evaluates in the JVM, interpreted, outside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGNIFICAND = 1 << 53


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """Σ a[j]·b[j], summed left to right."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y),
                       F.lit(0.0), lambda s, t: s + t)


def vector_sum(a) -> Column:
    return F.aggregate(_col(a), F.lit(0.0), lambda s, t: s + t)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """dot / (‖a‖·‖b‖); NULL when either norm is zero."""
    denominator = norm(a) * norm(b)
    return F.when(denominator != 0, dot(a, b) / denominator)


def seeded_uniform_vector(id_col, k: int, seed: int) -> Column:
    """k values in [0, 1) from a hash of (seed, id, position): same for every partitioning."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda f: F.pmod(F.xxhash64(F.lit(seed), _col(id_col), f), F.lit(_SIGNIFICAND))
        .cast("double") / float(_SIGNIFICAND))


def arithmetic_vector(id_col, k: int) -> Column:
    """Reproducible start values also computable in plain SQL (used by the SQL oracles).

    value(id, f) = ((id·7919 + f·104729) mod 1000 + 1) / 1001 for f = 1..k.
    """
    i = _col(id_col).cast("long")
    return F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda f: ((i * 7919 + f.cast("long") * 104729) % 1000 + 1).cast("double") / F.lit(1001.0))


def scatter_dense(entries, length, value_field: str = "val", pos_field: str = "pos",
                  zero=0) -> Column:
    """Dense array of ``length`` from entries sorted by unique 1-based ``pos``.

    Each entry contributes the run of zeros since the previous entry plus its value, and a
    final run pads to ``length``: linear in the output size, no per-position lookups.
    """
    e = _col(entries)
    n = F.lit(length) if isinstance(length, int) else _col(length)
    pieces = F.transform(e, lambda x, j: F.concat(
        F.array_repeat(F.lit(zero), x[pos_field] - F.coalesce(F.get(e, j - 1)[pos_field], F.lit(0)) - 1),
        F.array(x[value_field])))
    last = F.coalesce(F.element_at(e, -1)[pos_field], F.lit(0))
    return F.concat(F.flatten(pieces), F.array_repeat(F.lit(zero), n - last))


def scatter_joined(entries, length, separator: str, value_field: str = "val", pos_field: str = "pos",
                   zero=0) -> Column:
    """``array_join(scatter_dense(...), separator)`` as text from the entries.

    A run of zeros is one ``rpad`` and ``concat_ws`` allocates the text once, so a row costs its entries and
    the bytes of its text; no array of ``length`` elements is made. Null values are left out, as by ``array_join``.
    """
    e = _col(entries)
    n = F.lit(length) if isinstance(length, int) else _col(length)
    more = f"{separator}{zero}"         # a run is padded by many of these at a time, in its one allocation
    zeros = lambda count: F.when(count > 0, F.rpad(
        F.lit(str(zero)), (count * len(more) - len(separator)).cast("int"), F.lit(more * 512)))
    pieces = F.transform(e, lambda x, j: F.array(
        zeros(x[pos_field] - F.coalesce(F.get(e, j - 1)[pos_field], F.lit(0)) - 1), x[value_field].cast("string")))
    last = F.coalesce(F.try_element_at(e, F.lit(-1))[pos_field], F.lit(0))
    return F.when(e.isNotNull(), F.concat_ws(separator, F.flatten(pieces), zeros(n - last)))
