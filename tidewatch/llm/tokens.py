"""Token ids of whole texts under a public tokenizer file, with a memo of words."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
# Words for which the tokenizer's steps are known to act letter by letter: printable ASCII and
# Latin-1 letters are stable under NFC, and their lower case does not depend on context.
_SIMPLE = re.compile(f"[!-~{_LATIN}]+")
# The file's own pre-tokenizer pattern, narrowed to the letters above.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
# Python splits at these, the tokenizer does not.
_ODD_SPACES = re.compile("[\x1c-\x1f]")
_MEMO_ENTRIES = 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordTokens:
    """Ids as little-endian unsigned 32-bit bytes; equal to encoding the whole text at once.

    The vocabulary's pre-tokenizer never joins what white space separates, so a text's ids
    are those of its words in a row. Frequent words are looked up in a memo of bounded size.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._letters = byte_letters()
        self._words: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        found = self._parts.get(part)
        if found is None:
            spelt = part if part.isascii() else "".join(
                map(self._letters.__getitem__, part.encode())
            )
            found = self._bytes([token.id for token in self._model.tokenize(spelt)])
            if len(self._parts) < _MEMO_ENTRIES:
                self._parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        found = self._words.get(word)
        if found is None:
            if _SIMPLE.fullmatch(word) and "<|" not in word:
                found = b"".join(map(self._part, _PARTS.findall(word.lower())))
            else:
                found = self._bytes(self._whole.encode(word, add_special_tokens=False).ids)
            if len(self._words) < _MEMO_ENTRIES:
                self._words[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if _ODD_SPACES.search(text):
            lines = text.split("\n")
            return b"".join(
                self._bytes(e.ids)
                for e in self._whole.encode_batch_fast(lines, add_special_tokens=False)
            )
        words = text.split()
        try:
            return b"".join(map(self._words.__getitem__, words))
        except KeyError:
            return b"".join(map(self._word, words))


def token_pieces(
    docs: DataFrame, tokenizer: str, *, longest: int, text: str = "text",
    keys: tuple[str, ...] = ("doc_id",), end_id: int = 0, ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``longest`` ids: the ``keys``, piece, start, length, ids_crc32 [, ids].

    A document is its ids followed by ``end_id``; NULL text is the empty text. Longer
    documents are cut into pieces of exactly ``longest`` ids and a last one that may be
    shorter. Each row gives its own pieces, so repeated rows and keys do.
    """
    kept = [T.StructField(name, docs.schema[name].dataType) for name in keys]
    out = T.StructType([
        *kept, T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.LongType()))] if ids else []),
    ])
    return docs.select(*keys, docs[text].alias("_text")).mapInArrow(
        _cutter(tokenizer, longest, end_id, len(keys), ids), out
    )


def _cutter(path: str, longest: int, end_id: int, keys: int, with_ids: bool) -> Callable:
    step = longest * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = WordTokens(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, piece, start, length, crc, spelt = [], [], [], [], [], []
            for row, text in enumerate(batch.column(keys)):
                data = tokens.encode(text.as_py() or "") + end
                for n, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    rows.append(row)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        spelt.append(np.frombuffer(part, dtype="<u4").astype("int64"))
            taken = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(keys)]
            arrays = [*taken, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                arrays.append(pa.array(spelt, pa.list_(pa.int64())))
            names = [*batch.schema.names[:keys], "piece", "start", "length", "ids_crc32",
                     *(["ids"] if with_ids else [])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return cut
