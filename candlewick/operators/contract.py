"""Stream message contracts: rename, validate, dead letter (PRJ-03, PRJ-06..08).

A message is JSON text with a ``type`` of ``trade``, ``ticker`` or
``orderbook``; other types are skipped (neither valid nor rejected) and
malformed JSON is rejected. Each field may arrive under its wire name or its
canonical name. Rules per field kind (lenient like the original contracts):

* ``str``: must be a JSON string.
* ``float``: a number, or text that parses as a number.
* ``enum``: a string from the allowed set.
* ``ts``: epoch milliseconds (number or digit text) or ISO-8601 text.
* ``levels``: array of objects with four ``float`` fields.

Validation is pure column expressions over one parsed VARIANT, so it runs
inside whole-stage codegen; the result carries an ``errors`` array and is
split into valid rows and a rejected (dead-letter) table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.timestamps import smart_timestamp


@dataclass(frozen=True)
class Field:
    name: str            # canonical name
    wire: str            # wire alias
    kind: str            # str | float | enum | ts | levels
    allowed: tuple = ()


LEVEL_FIELDS = ("ask_price", "bid_price", "ask_size", "bid_size")
LEVELS_TYPE = "array<struct<" + ",".join(f"{f}:double" for f in LEVEL_FIELDS) + ">>"

# The three contracts, canonical name / wire alias / kind.
CONTRACTS: dict[str, list[Field]] = {
    "trade": [
        Field("type", "type", "str"),
        Field("symbol", "code", "str"),
        Field("trade_price", "trade_price", "float"),
        Field("trade_volume", "trade_volume", "float"),
        Field("side", "ask_bid", "enum", ("ASK", "BID")),
        Field("timestamp", "trade_timestamp", "ts"),
    ],
    "ticker": [
        Field("type", "type", "str"),
        Field("symbol", "code", "str"),
        Field("open_price", "opening_price", "float"),
        Field("high_price", "high_price", "float"),
        Field("low_price", "low_price", "float"),
        Field("trade_price", "trade_price", "float"),
        Field("change", "change", "enum", ("RISE", "EVEN", "FALL")),
        Field("change_price", "change_price", "float"),
        Field("signed_change_rate", "signed_change_rate", "float"),
        Field("acc_trade_volume_24h", "acc_trade_volume_24h", "float"),
        Field("timestamp", "timestamp", "ts"),
    ],
    "orderbook": [
        Field("type", "type", "str"),
        Field("symbol", "code", "str"),
        Field("total_ask_size", "total_ask_size", "float"),
        Field("total_bid_size", "total_bid_size", "float"),
        Field("orderbook_units", "orderbook_units", "levels"),
        Field("timestamp", "timestamp", "ts"),
    ],
}


def _key_type(kind: str) -> str:
    return {"str": "variant", "enum": "variant", "float": "double", "ts": "string",
            "levels": LEVELS_TYPE}[kind]


def _keys(contracts) -> dict[str, str]:
    """Every wire and canonical key of the contracts with its field kind."""
    out: dict[str, str] = {}
    for c in contracts:
        for f in CONTRACTS[c]:
            for k in {f.wire, f.name}:
                out[k] = f.kind
    return out


def _extract(v: Column, keys: dict[str, str]) -> tuple[Column, Column]:
    """Two VARIANT casts for all keys at once: every key as text (presence:
    non-NULL for any non-null JSON value) and every key typed by its kind."""
    as_text = "struct<" + ",".join(f"`{k}`:string" for k in keys) + ">"
    typed = "struct<" + ",".join(f"`{k}`:{_key_type(t)}" for k, t in keys.items()) + ">"
    return F.try_variant_get(v, "$", as_text), F.try_variant_get(v, "$", typed)


def _get(t: Column, kind: str) -> Column:
    """Typed value from the typed extraction; NULL if it breaks the kind."""
    if kind in ("str", "enum"):
        return F.when(F.schema_of_variant(t) == F.lit("STRING"), t.cast("string"))
    if kind in ("float",):
        return t
    if kind == "ts":
        return smart_timestamp(t)
    if kind == "levels":
        # a level missing any field: joined field values show the NULL marker
        # (kept free of lambda functions so the stage stays code-generated)
        joined = F.concat_ws("|", *[F.array_join(t[x].cast("array<string>"), ",", "#") for x in LEVEL_FIELDS])
        return F.when(~F.contains(joined, F.lit("#")), t)
    raise ValueError(kind)


def _field(S: Column, f: Field, read) -> tuple[Column, Column]:
    """(present, typed): the wire name wins when present, else the canonical; ``read`` gives a key's typed value."""
    pw = S[f.wire].isNotNull()
    if f.wire == f.name:
        return pw, read(f.name)
    return pw | S[f.name].isNotNull(), F.when(pw, read(f.wire)).otherwise(read(f.name))


def _error(present: Column, typed: Column, f: Field) -> Column:
    if f.kind == "enum":
        bad = typed.isNull() | ~typed.isin(list(f.allowed))
    else:
        bad = typed.isNull()
    return F.when(~present, F.lit(f"{f.name}: required")) \
            .when(bad, F.lit(f"{f.name}: invalid {f.kind}"))


def rename_canonical(df: DataFrame, contract: str, variant: str = "_v") -> DataFrame:
    """Canonical columns pulled from either name (no validation)."""
    keys = _keys([contract])
    S, T = _extract(F.col(variant), keys)
    return df.select("*", *[_field(S, f, lambda k: _get(T[k], keys[k]))[1].alias(f.name) for f in CONTRACTS[contract]])


def parse_messages(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode message bytes/text once: ``_text``, ``_v`` (VARIANT) and ``_type``."""
    text = F.col(value).cast("string")
    p = df.select(*keep, text.alias("_text")).withColumn("_v", F.try_parse_json("_text"))
    # barrier: later filters read the parsed VARIANT instead of re-parsing
    # the text once per referenced field
    return _barrier(p.withColumn("_type", F.try_variant_get(F.col("_v"), "$.type", "string")))


def check_messages(parsed: DataFrame, keep: tuple[str, ...] = (), contracts=None) -> DataFrame:
    """Validate every message against the contract of its type in one pass.

    Output: ``keep``, ``_type``, ``_text``, one struct per contract with the
    canonical typed fields (NULL for messages of other types) and ``errors``
    (``malformed json`` for text that is not a JSON object; empty for valid
    messages and for unknown types, which are skipped).
    """
    contracts = list(contracts or CONTRACTS)
    fields = {(f.wire, f.name, f.kind, f.allowed): f for c in contracts for f in CONTRACTS[c]}
    users: dict[tuple, list[str]] = {}
    for c in contracts:
        for f in CONTRACTS[c]:
            users.setdefault((f.wire, f.name, f.kind, f.allowed), []).append(c)
    slot = {k: f"_f{i}" for i, k in enumerate(fields)}
    v = F.col("_v")
    keys = _keys(contracts)
    S, T = _extract(v, keys)
    ex = _barrier(parsed.select(*keep, "_type", "_text", S.alias("_S"), T.alias("_T")))
    read = {k: _get(F.col("_T")[k], kind).alias("_g_" + k) for k, kind in keys.items()}
    for kinds in (("ts",), ("levels",), ("str", "enum", "float")):
        ex = _barrier(ex.select("*", *[read[k] for k in keys if keys[k] in kinds]))
    cols = []
    for k, f in fields.items():
        present, typed = _field(F.col("_S"), f, lambda x: F.col("_g_" + x))
        mine = F.col("_type").isin(*users[k])
        cols += [F.when(mine, present).alias("_p" + slot[k]), F.when(mine, typed).alias("_t" + slot[k])]
    # barriers: the error and struct projections read these columns instead of
    # having the lookups inlined into every CASE branch, and each step's code
    # stays below the 8,000 bytes from which on the JVM does not compile a method
    bad = F.col("_S").isNull()                          # of all values objects alone become a struct
    typed = _barrier(ex.select(*keep, "_type", "_text", bad.alias("_bad"), *cols))
    told = [_error(F.col("_p" + slot[k]), F.col("_t" + slot[k]), f).alias("_e" + slot[k]) for k, f in fields.items()]
    typed = _barrier(typed.select(*keep, "_type", "_text", "_bad", *["_t" + s for s in slot.values()], *told))
    per_type_errs = F.when(F.col("_bad"), F.lit("malformed json"))
    for c in contracts:
        mine = [(f.wire, f.name, f.kind, f.allowed) for f in CONTRACTS[c]]
        per_type_errs = per_type_errs.when(F.col("_type") == F.lit(c), F.concat_ws("\n", *["_e" + slot[k] for k in mine]))
    per_type_errs = F.split(F.nullif(per_type_errs, F.lit("")), "\n")
    per_type_errs = F.coalesce(per_type_errs, F.array().cast("array<string>"))
    structs = []
    for c in contracts:
        keys = [(f.wire, f.name, f.kind, f.allowed) for f in CONTRACTS[c]]
        st = F.struct(*[F.col("_t" + slot[k]).alias(fields[k].name) for k in keys])
        structs.append(F.when(F.col("_type") == F.lit(c), st).alias(c))
    out = typed.select(*keep, "_type", "_text", *structs, per_type_errs.alias("errors"))
    return _barrier(out)


def _barrier(df: DataFrame) -> DataFrame:
    """Stop predicate pushdown below this point (``inline`` of a one-element
    array): filters on the result read computed columns instead of
    re-evaluating the validation expressions they were built from."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def check_contract(parsed: DataFrame, contract: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) for the rows of ``parsed`` whose type is ``contract``."""
    mine = parsed.where(F.col("_type") == F.lit(contract))
    checked = check_messages(mine, keep, [contract])
    valid = checked.where(F.size("errors") == 0).select(*keep, f"{contract}.*")
    rejected = checked.where(F.size("errors") > 0).select(
        *keep, F.col("_text").alias("raw"), F.lit(contract).alias("type"), "errors")
    return valid, rejected


def validate_contract(df: DataFrame, contract: str, value: str = "value",
                      keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Split messages of one contract type into (valid, rejected).

    ``valid`` has the canonical typed columns plus ``keep``; ``rejected`` has
    ``keep``, the raw text, the message type and an ``errors`` array.
    """
    return check_contract(parse_messages(df, value, keep), contract, keep)


def malformed_parsed(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``parsed`` that are not JSON objects, as dead letters."""
    bad = parsed.where(F.col("_v").isNull() | (F.substring(F.schema_of_variant("_v"), 1, 6) != "OBJECT"))
    return bad.select(*keep, F.col("_text").alias("raw"), F.lit(None).cast("string").alias("type"),
                      F.array(F.lit("malformed json")).alias("errors"))


def malformed(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages that are not JSON objects: dead letter with a reason."""
    return malformed_parsed(parse_messages(df, value, keep), keep)


def orderbook_levels(valid_orderbooks: DataFrame, keep=("symbol", "timestamp")) -> DataFrame:
    """One row per order-book level with its 0-based depth (PRJ-07)."""
    return valid_orderbooks.select(*keep, F.posexplode("orderbook_units").alias("level", "u")) \
        .select(*keep, "level", *[F.col(f"u.{x}").alias(x) for x in LEVEL_FIELDS])
