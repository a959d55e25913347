"""Text to ids and back, for characters and words."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Literal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tokenloom.functions.text import (
    SPECIALS,
    UNK_ID,
    char_to_id,
    id_to_chars,
    id_to_text,
    marked_word_tokens,
    token_to_id,
    without,
)
from tokenloom.functions.words import word_cutter
from tokenloom.operators.dictionary import map_elements
from tokenloom.session import MAX_BROADCAST_ROWS

MAX_CHARS = 0x110000


def small_table(vocab: DataFrame, max_rows: int) -> tuple[list[str], list[int]] | None:
    """Tokens and ids of a vocabulary of at most `max_rows` rows, else None."""
    rows = vocab.select("token", "id").limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return [r["token"] for r in rows], [r["id"] for r in rows]


def encode_chars(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "text",
    into: str = "ids",
    unk_policy: int | Literal["error", "drop"] = "error",
) -> DataFrame:
    """Adds the array of character ids. No row moves: the table is bounded by the code points."""
    chars, ids = small_table(vocab, MAX_CHARS)
    return df.withColumn(into, char_to_id(chars, ids, unk_policy)(F.col(text)))


@dataclass(frozen=True)
class CharEncoder:
    """`encode_chars` with one vocabulary, for rows of a table, or `in_task` for a column of texts inside a task."""

    vocab: DataFrame
    text: str = "text"
    unk_policy: int | Literal["error", "drop"] = "error"

    def __call__(self, df: DataFrame) -> DataFrame:
        return encode_chars(df, self.vocab, self.text, unk_policy=self.unk_policy)

    def in_task(self) -> Callable[[pa.Array], pa.Array]:
        return char_to_id(*small_table(self.vocab, MAX_CHARS), self.unk_policy).func


def decode_chars(df: DataFrame, vocab: DataFrame, ids: str = "ids", into: str = "decoded") -> DataFrame:
    chars, values = small_table(vocab, MAX_CHARS)
    return df.withColumn(into, id_to_chars(chars, values)(F.col(ids)))


def known_words(vocab: DataFrame, max_rows: int) -> tuple[tuple[list[str], list[int]], DataFrame]:
    """The words that a vocabulary numbers first, at most `max_rows`, and a table of the others.

    Ids follow falling frequency, so few of the words that texts have are left to be joined.
    """
    first = F.col("id") < max_rows
    known = small_table(vocab.filter(first), max_rows)
    rest = vocab.filter(~first) if known else vocab
    return known or ([], []), rest.select("token", F.col("id").cast("int").alias("id"))


def encode_words(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    text: str = "text",
    into: str = "ids",
    max_rows: int = MAX_BROADCAST_ROWS,
    keep_text: bool = True,
) -> DataFrame:
    """Adds the array of word ids; unknown words get [UNK]. The text is dropped unless `keep_text`.

    A vocabulary within `max_rows` is looked up inside the tasks, so no row moves. Of a larger one so are its
    first words, and each block of rows meets the others that it has, see `dictionary`.
    """
    small = small_table(vocab, max_rows)
    columns = [c for c in df.columns if c != into and (keep_text or c != text)]
    if small:
        return df.withColumn(into, token_to_id(*small, UNK_ID)(marked_word_tokens(F.col(text)))).select(*columns, into)
    known, table = known_words(vocab, max_rows)
    texts = df.select(*columns, F.col(text).alias("_words"))
    coded = map_elements(texts, "_words", table, "token", "id", lambda ids: ids, into, ArrayType(IntegerType()),
                         max_rows, F.lit(UNK_ID), known, word_cutter(df.sparkSession, marked=True))
    return coded.select(*columns, into)


def decode_words(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    ids: str = "ids",
    into: str = "decoded",
    skip_specials: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS,
    keep_ids: bool = True,
) -> DataFrame:
    """Adds the words joined by spaces, without special tokens unless asked for. The ids are dropped unless `keep_ids`.

    An id without a word stops the job, whatever the size of the vocabulary.
    """
    small = small_table(vocab, max_rows)
    hidden = list(range(len(SPECIALS))) if skip_specials else []
    columns = [c for c in df.columns if c != into and (keep_ids or c != ids)]
    if small:
        return df.withColumn(into, id_to_text(*small, hidden, " ")(F.col(ids))).select(*columns, into)
    (words, numbers), table = known_words(vocab, max_rows)
    unknown = F.raise_error(F.concat(F.lit("no token with id "), F.col("id").cast("string"))).cast("string")
    shown = df.select(*columns, F.col(ids).cast("array<int>").alias("_shown"))
    spelled = map_elements(shown, "_shown", table, "id", "token", lambda tokens: pc.binary_join(tokens, " "), into,
                           StringType(), max_rows, unknown, (numbers, words), without(hidden))
    return spelled.select(*columns, into)
