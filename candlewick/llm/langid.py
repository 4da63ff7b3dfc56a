"""Language identification by compression.

Each language gets a raw-content zstandard dictionary made of sample text. A
document is encoded with every dictionary; the language whose dictionary
gives the fewest bytes wins, and a narrow margin means rejection.
"""

from __future__ import annotations

from dataclasses import dataclass

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate

UNDETERMINED = "und"

#: Compressed pieces are at most this long, so that the dictionary stays near
#: the text through the whole of a long document.
PIECE_BYTES = 16_384

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normalise(text: str) -> bytes:
    """Lower-cased text with every ASCII non-letter turned into a single space."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split())


def fit_dictionaries(docs: DataFrame, where: Column | None = None, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                     docs_per_language: int = 80, chars_per_document: int = 2_000, dictionary_bytes: int = 65_536) -> dict[str, bytes]:
    """Raw dictionary content per language value.

    Bounded sample: of every language the ``docs_per_language`` labelled
    documents with the smallest ``xxhash64(doc_id)`` (ties by text), each
    giving at most ``chars_per_document`` characters, up to
    ``dictionary_bytes``. Rows with NULL language, NULL id or no letter in the
    text teach nothing.
    """
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
                      *([where.alias("ok")] if where is not None else [F.lit(True).alias("ok")]))
    src = src.where(F.col("ok") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # The rank runs on ids alone: a group limit in each task leaves a few rows per language to shuffle.
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (src.select("lang", "doc_id").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= docs_per_language)
           .select("lang", "doc_id").distinct())
    chosen = ids.collect()                                   # languages x docs_per_language rows
    if not chosen:
        return {}
    small = docs.sparkSession.createDataFrame(chosen, ids.schema)
    rows = (src.join(F.broadcast(small), ["lang", "doc_id"])
            .select("lang", "doc_id", F.xxhash64("doc_id").alias("h"), F.substring("text", 1, chars_per_document).alias("text"))
            .groupBy("lang", "doc_id", "h").agg(F.min("text").alias("text")).collect())
    out: dict[str, bytes] = {r["lang"]: b"" for r in chosen}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["doc_id"])):
        if len(out[r["lang"]]) < dictionary_bytes:
            out[r["lang"]] += normalise(r["text"]) + b" "
    return {k: v[:dictionary_bytes] for k, v in sorted(out.items())}


@dataclass(frozen=True)
class LanguageClassifier:
    """``dictionaries`` by language; rejects below ``min_margin`` (the share of
    bytes that the best dictionary saves against the second best)."""

    dictionaries: dict[str, bytes]
    min_margin: float = 0.005

    def make(self):
        """A function text -> (language, score, rejected), for one task."""
        coders = []
        for lang, content in self.dictionaries.items():
            p = zstandard.ZstdCompressionParameters(window_log=17, hash_log=15, chain_log=15, search_log=3, min_match=4,
                                                    strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
            if len(content) < 8:                             # too short for a dictionary: plain coder
                coders.append((lang, zstandard.ZstdCompressor(compression_params=p)))
                continue
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            coders.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=p)))
        least = self.min_margin

        def judge(raw: bytes | None) -> tuple[str, float, bool]:
            text = raw.decode("utf-8", "replace") if raw else ""
            if not coders or not any(map(str.isalpha, text)):
                return UNDETERMINED, 0.0, True
            data = normalise(text)
            pieces = [data[i:i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
            sizes = sorted((sum(len(c.compress(p)) for p in pieces), lang) for lang, c in coders)
            if len(sizes) == 1:
                return sizes[0][1], 1.0, False
            margin = 1.0 - sizes[0][0] / sizes[1][0] if sizes[1][0] else 0.0
            return sizes[0][1], margin, margin < least
        return judge


def identify(docs: DataFrame, model: LanguageClassifier, text: str = "text",
             names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` plus predicted language, score and rejection.

    NULL text, text without a letter, or a model without languages: ``und``,
    0.0, rejected. Ties between languages go to the first name, with score 0
    and rejected. Only the text is read; other columns, whatever their names,
    pass through. Repeated rows are judged one by one; an empty table gives
    an empty result.
    """
    return annotate(docs, text, model.make, [(names[0], T.StringType()), (names[1], T.DoubleType()), (names[2], T.BooleanType())])


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from learning: crc32 of the id as text, mod 4, is 2 (NULL id: not held out)."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 4 == 2, F.lit(False))
