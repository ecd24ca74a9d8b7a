"""Token counts by the whole-token shortcut.

A byte-pair vocabulary in which no entry has a word mark after another character never merges across the start of a
word, so a text's count is the sum over its pre-tokens: a run of spaces and the word that follows. Before any text is
read, `prove` finds out which vocabulary strings encode alone as one token. Those count one where they appear as a
pre-token; only the rest is merged, by the library itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tallyspark.llm.tables import arrow_rows, texts

MODEL = "piece_bpe_32k.model"
WORD_MARK = "▁"
#: Merged words that a worker process keeps over its tasks, and the longest word kept.
CACHE_WORDS = 400_000
CACHE_CHARS = 48


@dataclass(frozen=True)
class Proof:
    """What holds for a vocabulary: words that are one token, and whether texts may be cut before spaces."""

    whole: frozenset[str]
    cuts_at_spaces: bool


@lru_cache(maxsize=2)
def processor(path: str) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def prove(path: str) -> Proof:
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec, trainer = model.normalizer_spec, model.trainer_spec
    plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.add_dummy_prefix
    own_pieces = any(p.type == p.USER_DEFINED for p in model.pieces)
    across = any(WORD_MARK in p.piece.lstrip(WORD_MARK) for p in model.pieces)
    is_bpe = trainer.model_type == trainer.BPE and not trainer.treat_whitespace_as_suffix
    words = [p.piece[1:] for p in model.pieces if p.type == p.NORMAL and p.piece.startswith(WORD_MARK)]
    words = [w for w in words if w and not w.startswith(WORD_MARK)]
    encoded = processor(path).encode(words, num_threads=1)
    whole = frozenset(w for w, ids in zip(words, encoded, strict=True) if len(ids) == 1)
    return Proof(whole, plain and is_bpe and not own_pieces and not across)


class WordCounts(dict):
    """Tokens of a pre-token, given without its word mark."""

    def __init__(self, path: str, proof: Proof) -> None:
        super().__init__(dict.fromkeys(proof.whole, 1))
        self.merge = processor(path).encode
        self.room = CACHE_WORDS

    def __missing__(self, word: str) -> int:
        n = len(self.merge(word)) if word else 1  # a lone word mark is one token
        if self.room > 0 and len(word) <= CACHE_CHARS:
            self[word] = n
            self.room -= 1
        return n

    def of_text(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(WORD_MARK, " ").split(" ")
        if "" not in words:
            return sum(map(self.__getitem__, words))
        total = spaces = 0
        for word in words[:-1]:
            if word:
                total += self[" " * spaces + word]
                spaces = 0
            else:
                spaces += 1
        return total + self[" " * spaces + words[-1]]


@lru_cache(maxsize=2)
def word_counts(path: str, proof: Proof) -> WordCounts:
    return WordCounts(path, proof)


def token_counts(docs: DataFrame, model: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text; a null or empty text has no tokens.

    Repeated rows each return a row; a null doc_id stays null; other columns are not read.
    """
    path = model or public_tokenizers.path(MODEL)
    proof = docs.sparkSession.sparkContext.broadcast(prove(path))  # one entry for each vocabulary string at most
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_counts(path, proof.value)
        of_text = words.of_text if proof.value.cuts_at_spaces else (lambda t: len(words.merge(t)) if t else 0)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield arrow_rows(
                schema, doc_id=batch.column(0), n_bytes=batch.column(2), n_tokens=[of_text(t) for t in texts]
            )

    rows = texts(docs).select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
