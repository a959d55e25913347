"""Text functions registered for use in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.functions.text import PIECE_PATTERN, WORD_PATTERN
from tokenloom.operators.bpe import bpe_function

# A distinct word of the two texts as one character, by its place past the surrogates.
LETTER = (
    "decode(unhex(lpad(hex(array_position(known, w) + "
    "IF(array_position(known, w) >= 55296, 2048, 0)), 8, '0')), 'UTF-32')"
)
WORD_EDITS = f"""
element_at(transform(array(array_distinct(concat(word_tokenize(a), word_tokenize(b)))), known -> levenshtein(
  array_join(transform(word_tokenize(a), w -> {LETTER}), ''),
  array_join(transform(word_tokenize(b), w -> {LETTER}), ''))), 1)"""


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def register_text_functions(spark: SparkSession, merges: DataFrame | None = None) -> None:
    """`char_tokenize`, `word_tokenize`, `piece_tokenize`, `word_edits`, `wer`, and `bpe_encode`
    if merges are given. All but the last are built-in expressions that the optimizer sees through.
    """
    bodies = {
        "char_tokenize(s STRING) RETURNS ARRAY<STRING>": "IF(s = '', CAST(array() AS ARRAY<STRING>), split(s, ''))",
        "word_tokenize(s STRING) RETURNS ARRAY<STRING>": f"regexp_extract_all(s, {_quoted(WORD_PATTERN)}, 0)",
        "piece_tokenize(s STRING) RETURNS ARRAY<STRING>": f"regexp_extract_all(s, {_quoted(PIECE_PATTERN)}, 0)",
        "word_edits(a STRING, b STRING) RETURNS INT": WORD_EDITS,
        "wer(a STRING, b STRING) RETURNS DOUBLE": "word_edits(a, b) / nullif(size(word_tokenize(b)), 0)",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    if merges is not None:
        spark.udf.register("bpe_encode_pieces", bpe_function(merges))
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION bpe_encode(s STRING) RETURNS ARRAY<INT> "
            "RETURN bpe_encode_pieces(piece_tokenize(s))"
        )
