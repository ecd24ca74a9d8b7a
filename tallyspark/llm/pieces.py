"""SentencePiece encoding by a table of prefixes, and decoding.

A merge-type (byte-pair) vocabulary gives every prefix of a text one encoding, and with it one last token. The table
holds that token for each prefix: an automaton over the vocabulary reports the tokens that end at a character, and of
these the one is right that can follow the last token of the prefix before it. Two tokens can follow each other if
their joined text encodes to just these two. A text's ids are then read off backwards, from the last prefix to the
first.

Work grows with the length of a text, however long a stretch without spaces is. Where no vocabulary string has a word
mark after another character, words encode alone, and a process keeps the ids of words it has met.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tallyspark.llm.tables import arrow_rows, texts
from tallyspark.llm.tokens import MODEL, WORD_MARK, processor, prove

#: What a worker process keeps over its tasks: ids of words, the longest word kept, and answers about pairs of tokens.
CACHE_WORDS = 200_000
CACHE_CHARS = 48
CACHE_PAIRS = 400_000
WORD = re.compile(f"{WORD_MARK}*[^{WORD_MARK}]+|{WORD_MARK}+")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, "<u4").tobytes()


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


class PrefixTable:
    """Ids of a text in which spaces are word marks already and nothing is put before it."""

    def __init__(self, path: str) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        #: Merges alone decide; any other kind of model is left to the library.
        self.holds = model.trainer_spec.model_type == model.trainer_spec.BPE and not any(
            p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces
        )
        spec = model.normalizer_spec
        #: Texts are encoded as they are, with a word mark before them and in place of spaces.
        self.plain = spec.add_dummy_prefix and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
        spec.add_dummy_prefix = False
        self.bare = SentencePieceProcessor(model_proto=model.SerializeToString())
        pieces = [p.piece for p in model.pieces if p.type == p.NORMAL]
        letters = sorted({c for p in pieces for c in p})
        # A string that doesn't encode to itself is never a token of any text. A letter without an entry of its own can
        # still merge, so it takes part as the ids its bytes get.
        known = dict.fromkeys([p for p, ids in zip(pieces, self.bare.encode(pieces, num_threads=1), strict=True) if len(ids) == 1])
        known |= dict.fromkeys(letters)
        self.text = list(known)
        self.ids = self.bare.encode(self.text, num_threads=1)
        self.letters = frozenset(letters)
        self.automaton = ahocorasick.Automaton()
        for token, text in enumerate(self.text):
            self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens' joined text encodes to the two."""
        pair = left * len(self.text) + right
        answer = self.pairs.get(pair)
        if answer is None:
            answer = self.bare.encode(self.text[left] + self.text[right]) == self.ids[left] + self.ids[right]
            if len(self.pairs) < CACHE_PAIRS:
                self.pairs[pair] = answer
        return answer

    def last_tokens(self, text: str) -> list[int | None]:
        """The last token of each prefix of a text; None after a letter that is in no vocabulary string."""
        last: list[int | None] = [None] * len(text)
        compatible = self.compatible
        for end, (token, length) in self.automaton.iter(text):
            if last[end] is None:
                before = end - length
                if before < 0 or last[before] is None or compatible(last[before], token):
                    last[end] = token
        return last

    def of_text(self, text: str) -> list[int]:
        last = self.last_tokens(text)
        found: list[list[int]] = []
        at = len(text)
        while at:
            token = last[at - 1]
            if token is None:
                if text[at - 1] in self.letters:
                    raise ValueError(f"the vocabulary gives a prefix no last token: {text[max(0, at - 40):at]!r}")
                found.append(self.bare.encode(text[at - 1]))
                at -= 1
            else:
                found.append(self.ids[token])
                at -= len(self.text[token])
        return [i for ids in reversed(found) for i in ids]


class WordIds(dict):
    """Packed ids of a word with its marks."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.proof = prove(path)
        self.table = PrefixTable(path)
        self.library = processor(path)
        self.begin, self.end = packed([self.library.bos_id()]), packed([self.library.eos_id()])

    def __missing__(self, word: str) -> bytes:
        ids = packed(self.table.of_text(word))
        if len(self) < CACHE_WORDS and len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        """All ids of a whole text, without begin and end."""
        if not text:
            return b""
        if not (self.table.plain and self.table.holds):
            return packed(self.library.encode(text))
        marked = WORD_MARK + text.replace(" ", WORD_MARK)
        if not self.proof.cuts_at_spaces:
            return packed(self.table.of_text(marked))
        return b"".join(map(self.__getitem__, WORD.findall(marked)))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers, with begin and end) of every whole text.

    Equal to the library's ids. A null or empty text is begin and end alone; special strings inside a text are text.
    Repeated rows each return a row; a null doc_id stays null; other columns are not read. Each row is one row's work.
    """
    path = model or public_tokenizers.path(MODEL)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            ids = [words.begin + words.of_text(t.as_py() or "") + words.end for t in batch.column(1)]
            yield arrow_rows(schema, doc_id=batch.column(0), ids=ids)

    return texts(docs).mapInArrow(work, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of `encode` with the text their ids stand for, as the library decodes them; null ids give no text."""
    path = model or public_tokenizers.path(MODEL)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = processor(path)
        for batch in batches:
            ids = (i.as_py() for i in batch.column(1))
            text = [None if i is None else library.decode(unpacked(i)) for i in ids]
            yield arrow_rows(schema, doc_id=batch.column(0), ids=batch.column(1), text=text)

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, ids binary, text string")


def token_count(ids: str = "ids") -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")
