"""Column-level PHP-serialized → JSON normalisation on Spark.

The JVM does everything it can; Python sees only the values that need the
recursive grammar:

1. null / ``""``                → ``""`` (or null with ``null_as_empty=False``)
2. not gated (``GATE_REGEX``)   → unchanged
3. ``N;…``                      → ``null``          (native)
4. ``i:<n>;`` / ``b:<n>;`` with a plain 1-18 digit integer → native cast
5. everything else gated        → Arrow-batched Python UDF

Spark evaluates a Python UDF for every input row of its batch, even inside a
``CASE WHEN`` branch, so the UDF's *argument* is nulled for rows the JVM
already handled: those cross the Arrow boundary as nulls and cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions.phpserial import GATE_REGEX, serialized_to_json
from tessera.operators.fitting import free_name
from tessera.session import ship_package

_INT = r"^i:(-?[0-9]{1,18});"
_BOOL = r"^b:(-?[0-9]{1,18});"


#: Bytes of texts that are parsed and handed back together; an Arrow batch of long texts is far larger.
SLICE_BYTES = 4 << 20


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The batch in slices of at most ``SLICE_BYTES``, or of one text."""
    start = held = 0
    for k, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if k > start and held + size > SLICE_BYTES:
            yield texts.slice(start, k - start)
            start, held = k, 0
        held += size
    yield texts.slice(start)


def _convert(batch: pa.Array, strict: bool) -> pa.Array:
    # Serialized settings repeat (the same value in many rows and tenants):
    # each distinct text is parsed once per slice. The memo lives only for the
    # slice, so what Python holds besides the Arrow batch stays small.
    memo: dict[str, str] = {}
    out = []
    for v in batch:
        v = v.as_py()
        if v is None:
            out.append(None)
            continue
        r = memo.get(v)
        if r is None:
            r = memo[v] = serialized_to_json(v, strict)
        out.append(r)
    return pa.array(out, batch.type)


@F.arrow_udf(StringType())
def serialized_to_json_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in _slices(batch):
            yield _convert(texts, False)


@F.arrow_udf(StringType())
def serialized_to_json_strict_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in _slices(batch):
            yield _convert(texts, True)


def is_serialized(col: Column | str) -> Column:
    """The gate: starts with ``a: s: i: d: O: b:`` or ``N;`` (case-sensitive)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(GATE_REGEX)


#: Tokens of a flat array that are read without Python: integers, booleans, null, and strings without a quote.
_FLAT_TOKEN = r'i:-?\d{1,18};|b:[01];|N;|s:\d{1,9}:"[^"]*";'


def flat_array_json(col: Column | str) -> Column:
    """JSON of a flat serialized array by JVM expressions alone; null for any other text.

    The text is cut into tokens as if it were flat and had plain values (integers, booleans, null, strings of
    printable ASCII without quotes and backslashes), then written again from the tokens with counted lengths. Only if that
    is the text, byte for byte, and all keys differ, the tokens are what the array holds.
    """
    c = F.col(col) if isinstance(col, str) else col
    tokens = F.regexp_extract_all(c, F.lit(_FLAT_TOKEN), F.lit(0))
    content = lambda t: F.regexp_extract(t, r'^s:\d+:"(.*)";$', 1)
    number = lambda t: F.regexp_extract(t, r"^i:(-?\d+);$", 1)
    is_text = lambda t: t.startswith("s:")
    exact = F.forall(tokens, lambda t: F.when(is_text(t), t == F.concat(F.lit("s:"), F.octet_length(content(t)).cast("string"), F.lit(':"'), content(t), F.lit('";')))
                     .when(t.startswith("i:"), number(t).try_cast("bigint").cast("string") == number(t)).otherwise(True))
    pairs = F.floor(F.size(tokens) / 2).cast("int")
    places = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).otherwise(F.array().cast("array<int>"))
    keys = F.transform(places, lambda k: F.get(tokens, 2 * k))
    names = F.transform(keys, lambda t: F.when(is_text(t), content(t)).otherwise(number(t)))
    value = lambda t: (F.when(is_text(t), F.concat(F.lit('"'), content(t), F.lit('"'))).when(t == "N;", "null")
                       .when(t == "b:1;", "true").when(t == "b:0;", "false").otherwise(number(t)))
    written = F.concat(F.lit("a:"), pairs.cast("string"), F.lit(":{"), F.array_join(tokens, ""), F.lit("}"))
    flat = ((written == c) & (F.size(tokens) % 2 == 0) & exact & F.forall(keys, lambda t: is_text(t) | t.startswith("i:"))
            & (F.size(F.array_distinct(names)) == pairs))
    json = F.concat(F.lit("{"), F.array_join(F.transform(places, lambda k: F.concat(F.lit('"'), F.get(names, k), F.lit('": '), value(F.get(tokens, 2 * k + 1)))), ", "),
                    F.lit("}"))
    # Cheap tests first: only texts that may be flat are cut up.
    return F.when(c.rlike(r"^a:\d{1,9}:\{[\x20-\x5b\x5d-\x7e]*\}$"), F.when(flat, json))


def php_to_json_expr(col: Column | str, null_as_empty: bool = True, strict_json: bool = False,
                     gate: Column | None = None, flat: Column | None = None) -> Column:
    """Column expression implementing the full per-value rule. ``flat`` is what JVM expressions made of flat arrays (or null)."""
    c = F.col(col) if isinstance(col, str) else col
    # A null flag means "not flagged": a null condition would fall through
    # to the native branches below.
    gated = is_serialized(c) if gate is None else (is_serialized(c) & F.coalesce(gate, F.lit(False)))
    native_null = c.startswith("N;")
    native_int = c.rlike(_INT)
    native_bool = c.rlike(_BOOL)
    flat = F.lit(None).cast("string") if flat is None else flat
    native = native_null | native_int | native_bool | flat.isNotNull()
    udf = serialized_to_json_strict_udf if strict_json else serialized_to_json_udf
    python = udf(F.when(gated & ~native, c))
    empty = F.lit("") if null_as_empty else F.lit(None).cast("string")
    return (F.when(c.isNull() | (c == ""), empty)
             .when(~gated, c)
             .when(native_null, F.lit("null"))
             .when(native_int, F.regexp_extract(c, _INT, 1).cast("bigint").cast("string"))
             .when(native_bool, F.when(F.regexp_extract(c, _BOOL, 1).cast("bigint") != 0, "true")
                               .otherwise("false"))
             .when(flat.isNotNull(), flat)
             .otherwise(python))


def normalize_column(df: DataFrame, col: str = "value", flag_col: str | None = None,
                     keep_original: bool = False, null_as_empty: bool = True,
                     strict_json: bool = False, spread: int | None = None, native_flat: bool = False) -> DataFrame:
    """Replace ``col`` in place with its JSON form; other columns untouched.

    ``spread`` deals the rows out to that many tasks first: for an input of one or a few row groups,
    as the parser costs far more per row than the scan. Building the plan runs no job.

    ``native_flat`` settles flat arrays by JVM expressions (``flat_array_json``), so that Python only sees the others.

    ``flag_col`` restricts conversion to rows where that column is 1 (e.g. a
    ``serialize`` flag); ``keep_original`` adds ``<col>_original``.
    """
    ship_package(df.sparkSession)  # the UDF is unpickled by module name on workers
    gate = (F.col(flag_col) == 1) if flag_col else None
    out = df.repartition(spread) if spread else df
    if keep_original:
        out = out.withColumn(f"{col}_original", F.col(col))
    if not native_flat:
        return out.withColumn(col, php_to_json_expr(col, null_as_empty, strict_json, gate))
    flat = free_name(out.columns, "_flat")
    return (out.withColumn(flat, flat_array_json(F.col(f"`{col}`")))
               .withColumn(col, php_to_json_expr(col, null_as_empty, strict_json, gate, F.col(flat))).drop(flat))


def is_error_json(col: Column | str) -> Column:
    """True where a converted value is an error object."""
    c = F.col(col) if isinstance(col, str) else col
    return c.startswith('{"error": ')
