"""Exchange-style stream messages derived from ``events``, and their
validation into typed rows plus a dead-letter table.

Mapping: ``click``/``purchase`` -> trade, ``view`` -> ticker, ``error`` ->
orderbook, anything else keeps its own (unknown, skipped) type. The symbol is
``KRW-U<user_id>``. ``props.k`` (0-99) picks the message shape, so every
contract rule is exercised by the data itself:

* k < 5: malformed JSON;  5-9: price field missing;  10-14: enum/levels
  violation;  15-19: symbol sent as a number (all rejected)
* 20-39: numeric text in a float field;  40-69: wire names, ms times;
  70-99: canonical names, ISO times (all valid)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators import contract as C

TYPE_OF_EVENT = {"click": "trade", "purchase": "trade", "view": "ticker", "error": "orderbook"}


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def messages_from_events(events: DataFrame) -> DataFrame:
    """``event_id, ts, value`` (JSON text) for every event."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = events.select("event_id", "user_id", "event_type", "value", "ts", k.alias("k"))
    mtype = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in TYPE_OF_EVENT.items() for x in kv]),
                                    F.col("event_type")), F.col("event_type"))
    e = e.withColumn("mtype", mtype)
    sym = F.concat(F.lit("KRW-U"), F.col("user_id").cast("string"))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    price, qty, t = F.col("value"), F.col("k").cast("double"), F.col("mtype")
    side = F.when(F.col("user_id") % 2 == 0, F.lit("BID")).otherwise(F.lit("ASK"))
    K = F.col("k")
    units = F.array(*[F.struct(price.alias("ask_price"), (price - F.lit(0.01 * i)).alias("bid_price"),
                               qty.alias("ask_size"), (qty + F.lit(float(i))).alias("bid_size")) for i in range(3)])
    bad_units = F.array(F.struct(price.alias("ask_price"), price.alias("bid_price"), qty.alias("ask_size"),
                                 F.lit(None).cast("double").alias("bid_size")))   # omitted by to_json

    wire = K < 70                                       # else canonical names, ISO time
    as_text = (K >= 20) & (K < 40)                      # numeric text in the price field
    drop = (K >= 5) & (K < 10)                          # price field missing
    bad_enum = (K >= 10) & (K < 15)
    code_num = (K >= 15) & (K < 20)                     # symbol sent as a JSON number

    def name(w, c, v):
        """(wire, canonical) field pair: only one is set; to_json omits NULLs."""
        return {w: F.when(wire, v), c: F.when(~wire, v)}

    def js(fields: dict, price_field: str) -> Column:
        def build(text_price: bool):
            f = dict(fields)
            f[price_field] = F.when(~drop, price.cast("string") if text_price else price)
            return _json(**f)
        return F.when(as_text, build(True)).otherwise(build(False))

    ts_text = F.when(wire, ms.cast("string")).otherwise(iso)   # digit text or ISO
    trade = js({"type": t, **name("code", "symbol", sym), "trade_price": None, "trade_volume": qty,
                **name("ask_bid", "side", F.when(bad_enum, F.lit("SELL")).otherwise(side)),
                "trade_timestamp": F.when(wire, ms), "timestamp": F.when(~wire, iso)}, "trade_price")
    ticker = js({"type": t, **name("code", "symbol", sym), **name("opening_price", "open_price", price),
                 "high_price": price, "low_price": price, "trade_price": None,
                 "change": F.when(bad_enum, F.lit("UP")).otherwise(F.lit("RISE")),
                 "change_price": F.lit(0.0), "signed_change_rate": F.lit(0.0), "acc_trade_volume_24h": qty,
                 "timestamp": ts_text}, "trade_price")
    orderbook = js({"type": t, **name("code", "symbol", sym), "total_ask_size": qty, "total_bid_size": None,
                    "orderbook_units": F.when(bad_enum, bad_units).otherwise(units), "timestamp": ts_text},
                   "total_bid_size")
    body = F.when(t == "trade", trade).when(t == "ticker", ticker).when(t == "orderbook", orderbook) \
            .otherwise(_json(type=t, code=sym, value=price))
    body = F.when(code_num, F.regexp_replace(body, '"code":"KRW-U([0-9]+)"', '"code":$1')).otherwise(body)
    text = F.when(K < 5, F.concat(F.lit('{"type": "'), t, F.lit('", "code": '))).otherwise(body)
    return e.select("event_id", "ts", "mtype", "user_id", text.alias("value"))


def validate_all(msgs: DataFrame, keep=("event_id",)) -> tuple[DataFrame, DataFrame]:
    """One parse and one validation pass over all contracts: (valid rows in a
    common shape, rejected rows with their first reason)."""
    checked = C.check_messages(C.parse_messages(msgs, "value", keep), keep)
    t = F.col("_type")
    price = F.when(t == "trade", F.col("trade.trade_price")).when(t == "ticker", F.col("ticker.trade_price")) \
             .when(t == "orderbook", F.col("orderbook.total_bid_size"))
    qty = F.when(t == "trade", F.col("trade.trade_volume")).when(t == "ticker", F.col("ticker.acc_trade_volume_24h")) \
           .when(t == "orderbook", F.col("orderbook.total_ask_size"))
    sym = F.coalesce(F.col("trade.symbol"), F.col("ticker.symbol"), F.col("orderbook.symbol"))
    ts = F.coalesce(F.col("trade.timestamp"), F.col("ticker.timestamp"), F.col("orderbook.timestamp"))
    valid = checked.where(t.isin(*C.CONTRACTS) & (F.size("errors") == 0)).select(
        *keep, t.alias("type"), sym.alias("symbol"), price.alias("price"), qty.alias("qty"),
        F.unix_millis(ts).alias("ts_ms"))
    rejected = checked.where(F.size("errors") > 0).select(
        *keep, F.when(~F.col("errors")[0].startswith("malformed"), t).alias("type"),
        F.col("errors")[0].alias("reason"))
    return valid, rejected


def valid_by_type(msgs: DataFrame, contract: str, keep=("event_id",)) -> DataFrame:
    parsed = C.parse_messages(msgs, "value", keep)
    v, _ = C.check_contract(parsed, contract, keep)
    return v
