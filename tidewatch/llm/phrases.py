"""Phrase mining over a prefix-free parse: copies of a passage are counted once, by weight.

Texts become words and separators. Windows of three symbols whose hash says so are triggers;
a text is cut into chunks that run from one trigger to the end of the next, so neighbours
overlap by a window, the same passage yields the same chunks wherever it stands, and no chunk
starts like the end of another. Distinct chunks and their frequencies make the dictionary. A
phrase of up to four words that starts in a chunk before its closing trigger lies wholly in
it, and in no other one at that place: phrases are counted by their starts, so overlaps count
once. Longer phrases are looked for only where both their shorter ones are frequent; a filter
of bounded size that errs on one side tells where, and exact counts follow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import table
from tidewatch.llm.shingles import mix
from tidewatch.sources.work import WorkTables

# Words of the longest phrase.
LONGEST = 4
# Symbols that neighbouring chunks share: a phrase less its first word.
OVERLAP = LONGEST - 1
# One window in so many is a trigger.
SPACING = 24
# Bits of a filter per key, and at most in all (64 MB); beyond that it lets more pass to the counts.
FILTER_BITS, MOST_FILTER_BITS = 32, 2**29

# Bytes that end a piece. None can be in a word, so they serve as marks as well.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK, _TRIGGERED, _LAST = b".", b";", b":"
_PLAIN = bytes(
    _BREAK[0] if byte in _ENDS else byte + 32 if 65 <= byte <= 90 else byte for byte in range(256)
)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MEMO_ENTRIES = 400_000
_BATCH_BYTES = 2**22
# Bytes of chunks that are worked out at once.
_RUN_BYTES = 2**23


class _Words(dict):
    """Symbol -> 64-bit hash, remembered up to a bounded number of symbols; marks have 0 to 2."""

    def __init__(self) -> None:
        super().__init__({_BREAK: 0, _TRIGGERED: 1, _LAST: 2})

    def __missing__(self, word: bytes) -> int:
        value = max(xxhash.xxh3_64_intdigest(word), 3)
        if len(self) < _MEMO_ENTRIES:
            self[word] = value
        return value

    def of(self, symbols: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, symbols), dtype=np.uint64, count=len(symbols))


def symbols_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z) and one mark per end of a piece."""
    return (text or "").encode().translate(_PLAIN).replace(_BREAK, b" . ").split()


def parse(text: str | None, words: _Words, spacing: int = SPACING) -> Iterator[bytes]:
    """Chunks of a text: symbols parted by blanks, closed by a mark for how the chunk ends."""
    symbols = symbols_of(text)
    if not symbols:
        return
    hashes = words.of(symbols)
    starts = [0]
    if len(symbols) > OVERLAP:
        window = np.zeros(len(symbols) - OVERLAP + 1, dtype=np.uint64)
        for i in range(OVERLAP):
            window = window * _STEP + hashes[i:len(window) + i]
        hits = np.flatnonzero(mix(window) % np.uint64(spacing) == 0).tolist()
        starts += [at for at in hits if at > 0]
    for at, to in zip(starts, starts[1:]):
        yield b" ".join([*symbols[at:to + OVERLAP], _TRIGGERED])
    yield b" ".join([*symbols[starts[-1]:], _LAST])


def dictionary_of(docs: DataFrame, *, text: str, lang: str, spacing: int = SPACING) -> DataFrame:
    """(lang, chunk, weight): distinct chunks per language and how often they were cut.

    NULL texts are empty, NULL languages are ``und``. Every row counts, also repeated ones.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            langs, chunks, size = [], [], 0
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                for chunk in parse(own.as_py(), words, spacing):
                    langs.append(name)
                    chunks.append(chunk)
                    size += len(chunk)
                    if size > _BATCH_BYTES:
                        yield _batch(langs, chunks)
                        langs, chunks, size = [], [], 0
            yield _batch(langs, chunks)

    def _batch(langs: list[str], chunks: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(chunks, pa.binary()).cast(pa.string())],
            names=["lang", "chunk"])

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).cast("string").alias("text"))
    cuts = rows.mapInArrow(cut, "lang string, chunk string")
    return cuts.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("weight"))


def _ahead(values: np.ndarray, places: int) -> np.ndarray:
    """What stands so many places further on; zero beyond the end."""
    moved = np.zeros_like(values)
    moved[:max(len(values) - places, 0)] = values[places:]
    return moved


class _Grams:
    """The symbols of a run of chunks and, for each place, which phrases start there."""

    def __init__(self, langs: list[str], codes: np.ndarray, weights: np.ndarray,
                 words: _Words) -> None:
        triggered = codes == 1
        closing = triggered | (codes == 2)
        sizes = np.diff(np.flatnonzero(closing), prepend=-1)
        self.given = weights
        self.weights = np.repeat(weights, sizes)
        self.rows = np.repeat(np.arange(len(langs)), sizes)
        seeds = {name: words[name.encode()] for name in set(langs)}
        of_rows = np.fromiter(map(seeds.__getitem__, langs), np.uint64, len(langs))
        self._seeds = np.repeat(mix(of_rows), sizes)
        self._codes = codes
        self._word = codes > 2
        # What starts within a closing trigger is counted in the next chunk.
        self._start = self._word.copy()
        for ahead in range(1, OVERLAP + 1):
            self._start &= ~_ahead(triggered, ahead)

    def within(self, n: int) -> np.ndarray:
        """Places where ``n`` words stand in a row."""
        held = self._word.copy()
        for i in range(1, n):
            held &= _ahead(self._word, i)
        return held

    def starts(self, n: int) -> np.ndarray:
        """Places where a phrase of ``n`` words is counted."""
        return self._start & self.within(n)

    def keys(self, n: int, places: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit key of the language and the ``n`` symbols from each (listed) place on."""
        seeds = self._seeds if places is None else self._seeds[places]
        total = seeds + np.uint64(n)
        for i in range(n):
            ahead = _ahead(self._codes, i) if places is None else self._codes[places + i]
            total = total * _STEP + ahead
        return mix(total)


class _Filter:
    """Set of 64-bit keys in a bit table: never misses one, takes few others for one."""

    def __init__(self, bits: np.ndarray) -> None:
        self._bits = bits
        self._size = np.uint64(8 * len(bits) - 1)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for part in (keys, keys >> np.uint64(32)):
            at = part & self._size
            found &= (self._bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _filter_of(keys: DataFrame) -> Broadcast:
    """The keys of a frame as a broadcast bit table of bounded size, filled by Spark."""
    count = keys.count()
    size = 2**12
    while size < min(FILTER_BITS * count, MOST_FILTER_BITS):
        size *= 2
    key = F.col("key")
    places = F.explode(F.array(key, F.shiftrightunsigned(key, 32)))
    at = keys.select(places.alias("at")).select(F.col("at").bitwiseAND(size - 1).alias("at"))
    slots = at.groupBy(F.shiftright("at", 3).cast("int").alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1, int(at & 7))")).alias("bits"))
    bits = np.zeros(size // 8, dtype=np.uint8)
    found = slots.toArrow()
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().astype(np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def _with_codes(chunks: DataFrame) -> DataFrame:
    """Add ``codes``, the symbols' hashes, so that later steps need not split text again."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            codes = words.of("\n".join(batch.column(1).to_pylist()).encode().split())
            ends = np.flatnonzero((codes == 1) | (codes == 2)) + 1
            offsets = np.concatenate([[0], ends * 8]).astype(np.int64)
            held = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, held.cast(pa.binary())], names=[*batch.schema.names, "codes"])

    return chunks.select("lang", "chunk", "weight").mapInArrow(
        apply, "lang string, chunk string, weight long, codes binary")


def _over_chunks(
    chunks: DataFrame, schema: str,
    make: Callable[[_Grams, pa.Table], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """``make`` applied to runs of chunks of a few megabytes."""
    def run(parts: list[pa.RecordBatch], words: _Words) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), dtype=np.uint64)
        weights = rows["weight"].to_numpy().astype(np.int64)
        yield from make(_Grams(rows["lang"].to_pylist(), codes, weights, words), rows)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, waiting, size = _Words(), [], 0
        for batch in batches:
            step = max(1, batch.num_rows * _RUN_BYTES // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, step):
                waiting.append(batch.slice(at, step))
                size += waiting[-1].nbytes
                if size >= _RUN_BYTES:
                    yield from run(waiting, words)
                    waiting, size = [], 0
        if waiting:
            yield from run(waiting, words)

    return chunks.mapInArrow(apply, schema)


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of each one's first row, and its total weight."""
    if not len(keys):
        return keys, np.empty(0, np.int64), weights
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    return ranked[first], order[first], np.add.reduceat(weights[order], first)


def frequent_keys(
    chunks: DataFrame, n: int, least: int, shorter: Broadcast | None
) -> DataFrame:
    """Keys of the phrases of ``n`` words that occur ``least`` times, and of few others.

    A key stands for all phrases that share its 64 bits, so it misses none.
    """
    def make(grams: _Grams, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        at = grams.starts(n)
        if shorter is not None:
            frequent = grams.within(n - 1)
            inner = frequent.nonzero()[0]
            frequent[inner] = _Filter(shorter.value).holds(grams.keys(n - 1, inner))
            at &= frequent & _ahead(frequent, 1)
        places = at.nonzero()[0]
        keys, _, total = _added(grams.keys(n, places), grams.weights[places])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(total)], names=["key", "weight"])

    counted = _over_chunks(
        chunks.select("lang", "weight", "codes"), "key long, weight long", make)
    return counted.groupBy("key").agg(F.sum("weight").alias("weight")).filter(
        F.col("weight") >= least).select("key")


def phrase_counts(
    chunks: DataFrame, least: int, tables: WorkTables, longest: int = LONGEST
) -> DataFrame:
    """(lang, words, phrase, f): exact counts of the phrases that occur ``least`` times.

    ``words`` 0 and an empty phrase hold a language's number of words.
    """
    filters: list[Broadcast] = []
    for n in range(1, longest + 1):
        keys = tables.write(
            frequent_keys(chunks, n, least, filters[-1] if filters else None), f"frequent-{n}")
        filters.append(_filter_of(keys))

    def make(grams: _Grams, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = rows["lang"].to_pylist()
        # Symbols stand one blank or line end apart, so a phrase is a stretch of the text.
        text = "\n".join([*rows["chunk"].to_pylist(), ""]).encode()
        data = np.frombuffer(text, dtype=np.uint8)
        ends = np.flatnonzero((data == 32) | (data == 10))
        begins = np.concatenate([[0], ends[:-1] + 1])
        sizes = np.bincount(grams.rows[grams.starts(1)], minlength=len(langs)) * grams.given
        sums: dict[str, int] = {}
        for name, weight in zip(langs, sizes.tolist()):
            sums[name] = sums.get(name, 0) + weight
        found = [(name, 0, b"", weight) for name, weight in sums.items()]
        for n in range(1, longest + 1):
            places = grams.starts(n).nonzero()[0]
            keys = grams.keys(n, places)
            held = _Filter(filters[n - 1].value).holds(keys)
            # Keys gather a phrase's rows within this run only; Spark adds up the phrases.
            _, first, weights = _added(keys[held], grams.weights[places[held]])
            firsts = places[held][first]
            for row, begin, end, weight in zip(
                grams.rows[firsts].tolist(), begins[firsts].tolist(),
                ends[firsts + n - 1].tolist(), weights.tolist(),
            ):
                found.append((langs[row], n, text[begin:end], weight))
        columns = list(zip(*found)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([
            pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
            pa.array(columns[2], pa.binary()).cast(pa.string()), pa.array(columns[3], pa.int64()),
        ], names=["lang", "words", "phrase", "f"])

    counted = _over_chunks(chunks, "lang string, words int, phrase string, f long", make)
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).filter(
        (F.col("f") >= least) | (F.col("words") == 0))


def _part(start: int, words: int, source: str = "phrase") -> Column:
    """``words`` words of a phrase from the ``start``-th on."""
    return F.array_join(F.slice(F.split(source, " "), start, words), " ")


def _wide(column: str) -> Column:
    """A count in arithmetic of more than 64 bits."""
    return F.col(column).cast("decimal(20,0)")


def cut_counts(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, k, l, r) for every way to cut a phrase of two words or more in two.

    A part that makes up over a thousandth of all words can be a part of very many phrases;
    there are at most a thousand such of each length, so they travel to the phrases. Any other
    part meets at most its count / ``least`` phrases.
    """
    total = counts.filter("words = 0").agg(F.sum("f")).first()[0] or 0
    sides = [
        F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"),
                 (_part(1, k) if left else _part(k + 1, longest)).alias("part"))
        for k in range(1, longest) for left in (True, False)
    ]
    asked = counts.filter("words >= 2").select(
        "lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.array(*sides)).alias("cut")
    ).filter("cut.k < words").select("lang", "phrase", "a", "cut.*")
    parts = counts.filter(F.col("words").between(1, longest - 1)).select(
        F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), "f")
    same = (F.col("lang") == F.col("_lang")) & (F.col("part") == F.col("_part"))
    common = F.broadcast(parts.filter(F.col("f") * 1000 > F.lit(total)))
    held = asked.join(common, same, "left")
    columns = ["lang", "phrase", "a", "k", "left", "f"]
    met = held.filter(F.col("f").isNotNull()).select(columns)
    rest = held.filter(F.col("f").isNull()).select("lang", "phrase", "a", "k", "left", "part")
    known = met.unionByName(rest.join(parts, same).select(columns))
    return known.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
        F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))


def scored(cuts: DataFrame) -> DataFrame:
    """Add ``score``: floor(2000000 a / (l + r)), exact beyond 64 bits."""
    return cuts.withColumn("score", F.expr(
        "CAST(a AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + r)"))


def covered(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, longer): the greatest count of a longer phrase that holds the phrase."""
    inner = [
        F.when(F.col("words") >= at + n - 1, F.when(F.col("words") > n, _part(at, n)))
        for n in range(2, longest) for at in range(1, longest - n + 2)
    ]
    held = counts.filter("words >= 3").select(
        "lang", F.explode(F.array_compact(F.array(*inner))).alias("phrase"), "f")
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000,
    share: int = 80, spacing: int = SPACING, tables: WorkTables | None = None,
) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words per language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts a phrase, ``l`` and ``r`` its parts at the cut of the lowest ``score``
    floor(2000000 a / (l + r)) (the earliest such cut), ``n`` the language's words. Phrases of
    ``least`` occurrences or more count, but not those inside a longer one that occurs at least
    ``share`` percent as often. Order: score and a descending, phrase by its UTF-8 bytes.

    NULL texts are empty, NULL languages ``und``; repeated rows count as often as they stand
    there; an empty table gives no rows, and columns other than the two named play no part. A
    text of any length is parsed whole; one without a trigger is one chunk.
    """
    tables = tables or WorkTables(docs.sparkSession)
    chunks = tables.write(
        _with_codes(dictionary_of(docs, text=text, lang=lang, spacing=spacing)), "chunks")
    counts = tables.write(phrase_counts(chunks, least, tables), "phrases")
    best = scored(cut_counts(counts)).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    longer = covered(counts).select(
        F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), "longer")
    kept = best.join(
        longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left"
    ).filter(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * share)).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score",
        F.pmod(F.xxhash64("phrase"), F.lit(_SLICES)).alias("slice"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = kept.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = counts.filter("words = 0").select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    return ranked.join(sizes, F.col("lang") == F.col("_lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


# A language's phrases are ranked in so many slices first, and the slices' best together.
_SLICES = 64
LEAST, TOP, SHARE = 30, 2000, 80


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest phrases of each language of all documents."""
    return collocations(
        table(spark, folder, "documents").select("lang", "text"),
        least=LEAST, top=TOP, share=SHARE)


OP13_SQL = rf"""
WITH pieces AS (
       SELECT coalesce(lang, 'und') AS lang,
              unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?
-
]')) AS piece
       FROM documents),
     said AS (
       SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'),
                                lambda w: w <> '') AS w
       FROM pieces),
     grams AS (
       SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
       FROM (SELECT lang, n, w, unnest(range(1, len(w) - n + 2)) AS i
             FROM said, (SELECT unnest(range(1, {LONGEST} + 1)) AS n))),
     counts AS (SELECT lang, n, phrase, count(*) AS f FROM grams GROUP BY ALL),
     sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE n = 1 GROUP BY lang),
     candidates AS (
       SELECT lang, n, phrase, string_split(phrase, ' ') AS w, f AS a
       FROM counts WHERE n >= 2 AND f >= {LEAST}),
     cuts AS (
       SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
              CAST(CAST(c.a AS HUGEINT) * 2000000 // (l.f + r.f) AS BIGINT) AS score
       FROM (SELECT *, unnest(range(1, n)) AS k FROM candidates) c
       JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
       JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
     best AS (
       SELECT * FROM cuts
       QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     longer AS (
       SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS f
       FROM (SELECT *, unnest(range(1, n - m + 2)) AS i
             FROM (SELECT *, unnest(range(2, n)) AS m FROM candidates))
       GROUP BY ALL),
     ranked AS (
       SELECT b.*, CAST(row_number() OVER (PARTITION BY b.lang
                ORDER BY score DESC, a DESC, encode(b.phrase)) AS INTEGER) AS rank
       FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
       WHERE o.f IS NULL OR CAST(100 AS HUGEINT) * o.f < CAST({SHARE} AS HUGEINT) * a)
SELECT r.lang, rank, r.phrase, a, l, r, s.n, score
FROM ranked r JOIN sizes s ON s.lang = r.lang
WHERE rank <= {TOP}
"""
