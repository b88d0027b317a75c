"""Byte-level BPE over whole texts: ids with offsets, and back to bytes and characters.

A rank file lists byte strings; a text is split by a pattern and each match is merged by
ranks. The tokenizers library does that on letters that stand for bytes, with the merges
read off the ranks: a token's merge is the pair that the merges of lower rank leave of it.
Within a token's bytes merging runs as it would alone as long as nothing crosses its ends,
so no other pair can make that token, and the ids equal those of merging by ranks.
"""

from __future__ import annotations

import base64
import codecs
import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.llm.common import table
from tidewatch.llm.tokens import byte_letters

# Characters handed to the library at once; a longer text is cut where no match can lie across.
STRETCH = 200_000
# No match of a pattern holds a letter before something else, or white space after other signs.
_SAFE_CUT = regex.compile(r"(?<=\p{L})(?=[^\p{L}])|(?<=\S)(?=\s)")


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_of(token: bytes, rank: int, ranks: dict[bytes, int]) -> list[bytes]:
    """What merging by the ranks below ``rank`` leaves of a token: two parts, if it is reachable."""
    parts = [bytes([byte]) for byte in token]
    while len(parts) > 2:
        found = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
        best = min(found)
        if best >= rank:
            break
        at = found.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteTokens:
    """Encoder and decoder for one rank file, with the pattern that splits words of letters,
    numbers and other signs, each with the space before it."""

    def __init__(self, path: str) -> None:
        # A Spark task is one core; the library's own threads would compete with other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        letters = byte_letters()
        merges = [merge_of(token, rank, ranks)
                  for token, rank in sorted(ranks.items(), key=lambda item: item[1])]

        def spell(data: bytes) -> str:
            return "".join(map(letters.__getitem__, data))

        self._tokenizer = Tokenizer(models.BPE(
            vocab={spell(token): rank for token, rank in ranks.items()},
            merges=[(spell(pair[0]), spell(pair[1])) for pair in merges if len(pair) == 2],
            ignore_merges=True,
        ))
        # The byte-level pre-tokenizer holds the same pattern as the rank file's library.
        self._tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=True)
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self._bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for rank in ranks.values():
            spelt = self._tokenizer.id_to_token(rank)
            self._bytes[rank] = bytes(map(byte_of.__getitem__, spelt))
        self._known = np.zeros(len(self._bytes), dtype=bool)
        self._known[list(ranks.values())] = True
        self._lengths = np.array([len(data) for data in self._bytes], dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, in calls of at most about ``STRETCH`` characters."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        rows: list[int] = []
        waiting: list[str] = []
        size = 0

        def flush() -> None:
            found = self._tokenizer.encode_batch_fast(waiting, add_special_tokens=False)
            for row, encoding in zip(rows, found, strict=True):
                parts[row].append(np.array(encoding.ids, dtype=np.int32))
            rows.clear()
            waiting.clear()

        for row, text in enumerate(texts):
            for stretch in stretches(text):
                rows.append(row)
                waiting.append(stretch)
                size += len(stretch)
                if size >= STRETCH:
                    flush()
                    size = 0
        flush()
        empty = np.empty(0, dtype=np.int32)
        return [np.concatenate(own) if own else empty for own in parts]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token and the one after its last.

        A token that holds only some bytes of a character spans that whole character.
        """
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        # Number of the character each byte belongs to.
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self._lengths[ids])
        if not len(ids):
            return ends, ends
        return character[ends - self._lengths[ids]], character[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; ids outside the vocabulary have none."""
        inside = ids[(ids >= 0) & (ids < len(self._bytes))]
        return b"".join(map(self._bytes.__getitem__, inside.tolist()))

    def unknown(self, ids: np.ndarray) -> int:
        """How many ids the vocabulary does not hold."""
        inside = ids[(ids >= 0) & (ids < len(self._bytes))]
        return len(ids) - int(self._known[inside].sum())

    def spans(self, ids: np.ndarray) -> list[str]:
        """Characters that each token completes; a split one comes with its last token.

        Joined they are the decoded text. Bytes that form no character become U+FFFD, those
        left open at the end come with the last token.
        """
        steps = codecs.getincrementaldecoder("utf-8")(errors="replace")
        found = [steps.decode(self.decode(ids[i:i + 1])) for i in range(len(ids))]
        rest = steps.decode(b"", final=True)
        if rest:
            found[-1] += rest
        return found


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in parts of about ``size`` characters that tokenize as the whole does."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE_CUT.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


@functools.lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    """One encoder per worker process."""
    return ByteTokens(path)


def _appended(
    df: DataFrame, source: str, kind: str, fields: list[T.StructField],
    make: Callable[[pa.Array], Iterator[tuple[int, list[pa.Array]]]],
) -> DataFrame:
    """All columns of ``df`` but those named like ``fields``, and the fields made from ``source``.

    ``make`` gives, for a batch of the source column, consecutive runs of rows with their arrays.
    """
    kept = [name for name in df.columns if name not in {field.name for field in fields}]
    schema = T.StructType([*[df.schema[name] for name in kept], *fields])
    asked = df.select(*[df[f"`{name}`"] for name in kept],
                      df[f"`{source}`"].cast(kind).alias(_SOURCE))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*kept, *[field.name for field in fields]]
        for batch in batches:
            at = 0
            for rows, arrays in make(batch.column(len(kept))):
                part = batch.slice(at, rows)
                at += rows
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], *arrays], names=names)

    return asked.mapInArrow(apply, schema)


_SOURCE = "_source of the tokens"


def _runs(weights: Iterator[int], most: int) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of consecutive rows whose weights add up to about ``most``."""
    first = last = total = 0
    for weight in weights:
        last += 1
        total += weight
        if total >= most:
            yield first, last
            first, total = last, 0
    if last > first:
        yield first, last


def encode_texts(
    docs: DataFrame, ranks: str, *, text: str = "text", offsets: bool = False,
) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array of int) [, ``starts``, ``ends``] of each whole text.

    Every row is encoded, also repeated rows. NULL and empty texts have no ids. ``starts`` and
    ``ends`` count characters (code points): a token that holds a part of a character spans the
    whole one. Strings of special tokens are ordinary text. Columns of these names are replaced.
    A long text is handed on in stretches that cannot change a token, so memory holds one text
    and its ids, not the library's record of them.
    """
    numbers = pa.list_(pa.int32())
    names = ["ids", *(["starts", "ends"] if offsets else [])]

    def make(texts: pa.Array) -> Iterator[tuple[int, list[pa.Array]]]:
        tokens = byte_tokens(ranks)
        sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0)
        for first, last in _runs((size.as_py() + 1 for size in sizes), 4 * STRETCH):
            part = [value or "" for value in texts.slice(first, last - first).to_pylist()]
            columns = [tokens.encode(part)]
            if offsets:
                columns += map(list, zip(*map(tokens.offsets, part, columns[0])))
            yield last - first, [pa.array(column, numbers) for column in columns]

    fields = [T.StructField(name, T.ArrayType(T.IntegerType())) for name in names]
    return _appended(docs, text, "string", fields, make)


def decode_ids(
    df: DataFrame, ranks: str, *, ids: str = "ids", characters: bool = False,
) -> DataFrame:
    """All columns of ``df`` and ``decoded`` (binary), ``unknown`` [, ``decoded_text``, ``spans``].

    ``decoded`` joins the ids' bytes, which need not be whole characters; ids that are NULL or
    outside the vocabulary give none and are counted in ``unknown``. ``spans`` has the characters
    each token completes, ``decoded_text`` their whole, with U+FFFD for bytes that form none.
    NULL or empty ``ids`` decode to nothing. Columns of these names are replaced.
    """
    fields = [T.StructField("decoded", T.BinaryType()), T.StructField("unknown", T.LongType())]
    if characters:
        fields += [T.StructField("decoded_text", T.StringType()),
                   T.StructField("spans", T.ArrayType(T.StringType()))]

    def make(column: pa.Array) -> Iterator[tuple[int, list[pa.Array]]]:
        tokens = byte_tokens(ranks)
        sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0)
        for first, last in _runs((size.as_py() + 1 for size in sizes), 4 * STRETCH):
            part = column.slice(first, last - first)
            own = [_numbers(value.values) if value.is_valid else np.empty(0, np.int64)
                   for value in part]
            arrays = [pa.array(map(tokens.decode, own), pa.binary()),
                      pa.array(map(tokens.unknown, own), pa.int64())]
            if characters:
                spans = list(map(tokens.spans, own))
                arrays += [pa.array(map("".join, spans), pa.string()),
                           pa.array(spans, pa.list_(pa.string()))]
            yield last - first, arrays

    return _appended(df, ids, "array<bigint>", fields, make)


def _numbers(values: pa.Array) -> np.ndarray:
    """The ids of a row; NULL stands for an id that no vocabulary has."""
    return values.fill_null(-1).to_numpy(zero_copy_only=False)


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids and their way back, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ranks = ranks_path()
    decoded = decode_ids(encode_texts(docs, ranks).drop("text"), ranks)
    spelt = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelt, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
