"""Language identification by interpolated Kneser-Ney models of characters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm.common import crc_fold, table
from tidewatch.sources.work import WorkTables

ORDER = 4
_EDGE, _GAP = 1, 32  # classes of the start of a text and of everything that is no letter
_STRETCH = 500_000
_START = chr(_EDGE) * (ORDER - 1)
# Rows are dealt into so many folds; each is scored by a model of the others for calibration.
_FOLDS = 8
# Values of the sharpness that calibration tries.
_SHARPNESS = [1.0, 2.0, 5.0, 10.0, 20.0, 40.0, 80.0]
_SIXTEEN = np.uint64(16)
_HALVES = range(0xD800, 0xE000)  # UTF-16 halves of code points beyond the first 65,536


def _letter_classes() -> np.ndarray:
    classes = np.full(1 << 16, _GAP, dtype=np.uint16)
    letters = [c for c in range(1 << 16) if chr(c).isalpha()]
    classes[letters] = letters
    classes[_HALVES] = _HALVES
    classes[_EDGE] = _EDGE
    return classes


class Codes:
    """Texts as codes of four characters, 16 bits each: the three before, and the character.

    Case is lowered; runs of what is no letter are one gap; three edges stand before the
    text. A letter beyond the first 65,536 code points counts as two characters, its UTF-16
    halves, so no two texts of different letters have the same codes.
    """

    def __init__(self) -> None:
        self._classes = _letter_classes()

    def of(
        self, texts: Sequence[str], heads: Sequence[str] | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, number of the text of each code, whether a text has a letter).

        ``heads`` has the three characters before each text where that is the rest of a
        longer one.
        """
        heads = heads or [_START] * len(texts)
        joined = [(head + text.replace(_START[0], " ").lower()).encode("utf-16-le", "surrogatepass")
                  for head, text in zip(heads, texts, strict=True)]
        starts = np.cumsum([0, *(len(text) // 2 for text in joined)])[:-1]
        points = np.frombuffer(b"".join(joined), dtype=np.uint16)
        marks = self._classes[points]
        pairs = np.flatnonzero((points[:-1] >> 10 == 0xD800 >> 10) & (points[1:] >> 10 == 0xDC00 >> 10))
        if len(pairs):
            upper, lower = (points[pairs + half].astype(np.uint32) & 0x3FF for half in (0, 1))
            found, back = np.unique(0x10000 + (upper << 10 | lower), return_inverse=True)
            symbols = pairs[~np.array([chr(c).isalpha() for c in found])[back]]
            marks[symbols] = marks[symbols + 1] = _GAP
        keep = np.r_[True, (marks[1:] != _GAP) | (marks[:-1] != _GAP)][:len(marks)]
        real = np.ones(len(marks), dtype=bool)
        for place in range(ORDER - 1):
            keep[starts + place], real[starts + place] = True, False
        owner = np.zeros(len(marks), dtype=np.int64)
        owner[starts[1:]] = 1
        owner = np.cumsum(owner)[keep]
        marks, real = marks[keep].astype(np.uint64), real[keep]
        codes = marks.copy()
        for back in range(1, ORDER):
            codes[back:] |= marks[:-back] << np.uint64(16 * back)
        letters = np.bincount(
            owner[real & (marks != _GAP)], minlength=len(texts)) > 0
        return codes[real], owner[real], letters


def _head(before: str, part: str) -> str:
    """The last three characters of ``before`` and ``part``, runs of what is no letter as one gap.

    Letters of two UTF-16 halves count as two, so the first may be half a letter.
    """
    kept: list[str] = []
    for char in reversed(before + part):
        if not (char.isalpha() or char == _START[0] or ord(char) in _HALVES):
            kept += [" "] if kept[-1:] != [" "] else []
        elif ord(char) > 0xFFFF:
            rest = ord(char) - 0x10000
            kept += [chr(0xDC00 + (rest & 0x3FF)), chr(0xD800 + (rest >> 10))]
        else:
            kept.append(char)
        if len(kept) >= ORDER - 1:
            break
    return "".join(reversed(kept[:ORDER - 1]))


def _stretches(
    texts: Iterator[str | None]
) -> Iterator[tuple[list[int], list[str], list[str]]]:
    """Texts gathered into lists of about half a million characters: (row numbers, texts, heads).

    A longer text is cut into stretches that carry the characters before them, so that
    their codes are those of the whole text.
    """
    rows: list[int] = []
    gathered: list[str] = []
    heads: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        text = (text or "").replace(_START[0], " ").lower()
        head = _START
        for at in range(0, max(1, len(text)), _STRETCH):
            part = text[at:at + _STRETCH]
            rows.append(row)
            gathered.append(part)
            heads.append(head)
            size += len(part) + ORDER
            if len(part) == _STRETCH:
                head = _head(head, part)
            if size >= _STRETCH:
                yield rows, gathered, heads
                rows, gathered, heads, size = [], [], [], 0
    if rows:
        yield rows, gathered, heads


def count_codes(docs: DataFrame, *, text: str, lang: str) -> DataFrame:
    """(lang, code, n) over whole texts of rows with a language, added up per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Codes()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def fold(name: str) -> None:
            parts = held[name]
            codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([n for _, n in parts]), len(codes))
            held[name] = [(codes, counts.astype(np.int64))]

        for batch in batches:
            names = batch.column(1).to_numpy(zero_copy_only=False)
            for name in set(names):
                mine = batch.column(0).filter(pa.array(names == name)).to_pylist()
                for _, texts, heads in _stretches(mine):
                    codes, _, _ = reader.of(texts, heads)
                    held.setdefault(name, []).append(np.unique(codes, return_counts=True))
                    if len(held[name]) > 40:
                        fold(name)
        for name in held:
            fold(name)
            codes, counts = held[name][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(codes)), pa.array(codes.view(np.int64)), pa.array(counts)],
                names=["lang", "code", "n"])

    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counted = rows.select(text, F.col(lang).cast("string").alias("lang")).mapInArrow(
        run, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def order_counts(codes: DataFrame) -> DataFrame:
    """(lang, level, code, n): counts of the full order, and below it the number of distinct
    characters seen before each shorter code (Kneser-Ney's continuation counts)."""
    levels, current = [], codes.select("lang", F.lit(ORDER).alias("level"), "code", "n")
    for level in range(ORDER, 0, -1):
        levels.append(current)
        mask = (1 << (16 * (level - 1))) - 1
        current = current.groupBy("lang", F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(
            F.count(F.lit(1)).alias("n")).select(
            "lang", F.lit(level - 1).alias("level"), "code", "n")
    out = levels[0]
    for other in levels[1:]:
        out = out.unionByName(other)
    return out


@dataclass
class Level:
    """Sorted arrays of one order, keyed by whole codes: log-probabilities per code and language,
    and the log weight that a context leaves to the order below."""

    codes: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    left: np.ndarray


@dataclass
class LanguageModel:
    """Character models of several languages, with what calibrates their answers.

    ``sharpness`` turns differences of cross-entropy into chances; ``worst`` is the
    cross-entropy per character beyond which a text is rejected as none of the languages.
    """

    names: list[str]
    levels: list[Level]
    base: np.ndarray
    sharpness: float = 10.0
    worst: np.ndarray | None = None
    # Models of groups of the languages, in the order of ``names``, in place of ``levels``.
    parts: list[LanguageModel] = field(default_factory=list)

    def log_probabilities(self, codes: np.ndarray, level: int = ORDER) -> np.ndarray:
        """(codes x languages), interpolated down to the uniform distribution."""
        if self.parts:
            return np.hstack([part.log_probabilities(codes, level) for part in self.parts])
        if level == 0:
            return np.broadcast_to(self.base, (len(codes), len(self.names)))
        own = self.levels[level - 1]
        at, found = _find(own.codes, codes)
        out = own.logs[at] if len(own.codes) else np.zeros((len(codes), len(self.names)))
        if not found.all():
            miss = codes[~found]
            mask = np.uint64((1 << (16 * (level - 1))) - 1)
            below = np.array(self.log_probabilities(miss & mask, level - 1))
            where, known = _find(own.contexts, miss >> _SIXTEEN)
            below[known] += own.left[where[known]]
            out[~found] = below
        return out

    def cross_entropies(self, texts: Sequence[str | None], reader: Codes) -> tuple[np.ndarray, np.ndarray]:
        """(mean nats per character of each text and language, whether a text has a letter)."""
        sums = np.zeros((len(texts), len(self.names)))
        sizes, lettered = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        for rows, parts, heads in _stretches(texts):
            codes, owner, letters = reader.of(parts, heads)
            rows = np.array(rows)
            if len(codes):
                logs = self.log_probabilities(codes)
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                np.add.at(sums, rows[owner[starts]], np.add.reduceat(logs, starts, axis=0))
                sizes += np.bincount(rows[owner], minlength=len(texts))
            np.logical_or.at(lettered, rows, letters)
        return -sums / np.maximum(sizes, 1)[:, None], lettered


def _find(table_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table_):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(table_, wanted), len(table_) - 1)
    return at, table_[at] == wanted


def build_model(counted: pd.DataFrame, alphabet: int) -> LanguageModel:
    """Interpolated Kneser-Ney from counts per order; discounts from the counts of ones and twos."""
    names = sorted(counted["lang"].unique())
    number = {name: i for i, name in enumerate(names)}
    model = LanguageModel(names, [], np.full(len(names), -np.log(alphabet)),
                          worst=np.full(len(names), np.inf))
    for level in range(1, ORDER + 1):
        rows = counted[counted["level"] == level]
        codes, at = np.unique(rows["code"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        counts = np.zeros((len(codes), len(names)))
        counts[at, rows["lang"].map(number).to_numpy(int)] = rows["n"].to_numpy(float)
        contexts, of = np.unique(codes >> _SIXTEEN, return_inverse=True)
        total, types = (np.zeros((len(contexts), len(names))) for _ in range(2))
        np.add.at(total, of, counts)
        np.add.at(types, of, counts > 0)
        ones, twos = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        left = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
        mask = np.uint64((1 << (16 * (level - 1))) - 1)
        below = np.exp(model.log_probabilities(codes & mask, level - 1))
        own = np.maximum(counts - discount, 0) / np.maximum(total[of], 1)
        logs = np.log(own + left[of] * below).astype(np.float32)
        model.levels.append(Level(codes, logs, contexts, np.log(left).astype(np.float32)))
    return model


def calibrate(model: LanguageModel, fits: pd.DataFrame) -> None:
    """Sharpness of the best likelihood over a grid, and rejection bounds per language: four
    deviations beyond the mean cross-entropy of its own texts, of all texts where it has
    fewer than five, none for fewer than two of these.

    ``fits`` has per language the sums over its texts that :func:`_fits` makes.
    """
    def bound(sums: pd.Series) -> float:
        mean = sums["total"] / sums["n"]
        return mean + 4 * max(np.sqrt(max(sums["squares"] / sums["n"] - mean**2, 0.0)), 0.02)

    every = fits.sum()
    common = bound(every) if every["n"] >= 2 else np.inf
    own = {name: bound(sums) for name, sums in fits.iterrows() if sums["n"] >= 5}
    model.worst = np.array([own.get(name, common) for name in model.names])
    if every["n"]:
        model.sharpness = _SHARPNESS[int(np.argmax(every[_FIT_COLUMNS[3:]].to_numpy(float)))]


_FIT_COLUMNS = ["n", "total", "squares", *(f"fit_{i}" for i in range(len(_SHARPNESS)))]


def _fits(rows: DataFrame, model: LanguageModel) -> pd.DataFrame:
    """Per language of (text, lang) rows: number of texts with a letter, sums of their cross-entropies
    and of the squares, and log-likelihoods per sharpness, added up where the rows are."""
    number = {name: i for i, name in enumerate(model.names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Codes()
        for part in batches:
            entropies, lettered = model.cross_entropies(part["text"].tolist(), reader)
            truth = part["lang"].map(number)
            known = lettered & truth.notna().to_numpy()
            if not known.any():
                continue
            entropies = entropies[known]
            pairs = np.arange(len(entropies)), truth[known].to_numpy(int)
            own = entropies[pairs]
            likely = [np.log(_chances(entropies, s)[pairs].clip(1e-9)) for s in _SHARPNESS]
            values = [np.ones(len(own)), own, own**2, *likely]
            out = pd.DataFrame(dict(zip(_FIT_COLUMNS, values, strict=True)))
            yield out.groupby(part["lang"][known].to_numpy(object)).sum().rename_axis(
                "lang").reset_index()

    schema = "lang string, " + ", ".join(f"{name} double" for name in _FIT_COLUMNS)
    return rows.mapInPandas(run, schema).groupBy("lang").agg(
        *[F.sum(name).alias(name) for name in _FIT_COLUMNS]).toPandas()


def _chances(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    lifted = np.exp(-sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
    return lifted / lifted.sum(axis=1, keepdims=True)


UNKNOWN = "und"


def detect(model: LanguageModel) -> Column:
    """A Pandas UDF of a text: struct (lang, score, entropy, rejected).

    The language of the lowest cross-entropy per character; its chance; that
    cross-entropy; and whether it is beyond the language's calibrated bound. NULL, texts
    without a letter, and a model without languages give ``und``, 0, NULL, true.
    """
    kept: list[Codes] = []

    @F.pandas_udf("lang string, score double, entropy double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not kept:
            kept.append(Codes())
        for texts in batches:
            if not model.names:
                yield pd.DataFrame({
                    "lang": UNKNOWN, "score": 0.0, "entropy": None, "rejected": True,
                }, index=range(len(texts)))
                continue
            entropies, lettered = model.cross_entropies(texts.tolist(), kept[0])
            best = entropies.argmin(axis=1)
            least = entropies.min(axis=1)
            score = _chances(entropies, model.sharpness).max(axis=1)
            yield pd.DataFrame({
                "lang": np.where(lettered, np.array(model.names, dtype=object)[best], UNKNOWN),
                "score": np.where(lettered, score, 0.0),
                "entropy": np.where(lettered, least, np.nan),
                "rejected": ~lettered | (least > model.worst[best]),
            })

    return run


def train_language_model(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id",
    together: int = 64, tables: WorkTables | None = None,
) -> LanguageModel:
    """Learn from every row with a text and a language.

    Counts cover all texts and are kept by whole code, so nothing merges: the arrays grow with the
    distinct codes of a language, which pass through the driver, not with its texts. Any number
    of languages is learned; they are held in groups of ``together``, each with arrays of its own.
    Calibration covers all rows too: they are dealt into folds by a hash of ``key`` and text, and
    each fold is scored by a model of the others' counts; a language of fewer than five such rows
    takes the bound of all rows together.
    Rows of a NULL key count like others; without rows the model knows no language.
    """
    tables = tables or WorkTables(docs.sparkSession)
    fold = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(_FOLDS))
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), fold.alias("fold"))
    marked = F.concat(F.col("fold").cast("string"), "lang")
    found = tables.write(count_codes(
        rows.select("text", marked.alias("lang")), text="text", lang="lang"), "codes")
    split = found.select(F.substring("lang", 1, 1).cast("int").alias("fold"),
                         F.substring("lang", 2, 2**31 - 1).alias("lang"), "code", "n")

    def learned(counts: DataFrame) -> LanguageModel:
        return _built(counts.groupBy("lang", "code").agg(F.sum("n").alias("n")), together)

    model = learned(split)
    fits = []
    for number in sorted(row[0] for row in split.select("fold").distinct().collect()):
        trial = learned(split.filter(F.col("fold") != number))
        if trial.names:
            fits.append(_fits(rows.filter(F.col("fold") == number).select("text", "lang"), trial))
    fits = [part for part in fits if len(part)]
    if fits:
        calibrate(model, pd.concat(fits).groupby("lang").sum())
    return model


def _built(codes: DataFrame, together: int) -> LanguageModel:
    """The model of (lang, code, n), its languages in groups of ``together``."""
    counted = order_counts(codes).toArrow().to_pandas(categories=["lang"])
    alphabet = max(2, int((counted["level"] == 1).sum()))
    names = sorted(counted["lang"].unique())
    groups = [set(names[at:at + together]) for at in range(0, len(names), together)]
    parts = [build_model(counted[counted["lang"].isin(group)], alphabet) for group in groups]
    base = np.full(len(names), -np.log(alphabet))
    if len(parts) == 1:
        return parts[0]
    return LanguageModel(names, [], base, worst=np.full(len(names), np.inf), parts=parts)


HELD_OUT = 2


def op5_kneser_ney_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of the ids."""
    docs = table(spark, folder, "documents")
    model = train_language_model(docs.filter(crc_fold("doc_id", 4) != HELD_OUT))
    return docs.select(
        "doc_id", (crc_fold("doc_id", 4) == HELD_OUT).alias("held_out"),
        detect(model)(F.col("text")).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"),
             F.col("found.score").alias("score"), F.col("found.entropy").alias("entropy"),
             F.col("found.rejected").alias("rejected"))
