"""Language, quality and rules: statistics by brute force, held-out accuracy, edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_frames import awkward, documents, with_clashes
from tidewatch.llm import decision_list as rules
from tidewatch.llm import language, line_dedup, quality_zstd
from tidewatch.llm.common import crc_fold
from tidewatch.sources.work import WorkTables

FOLDER = "/root/testdata/sf0.01"


# ---- language ---------------------------------------------------------------


def brute_model(texts):
    """Interpolated Kneser-Ney of one language with plain dictionaries; log-probability of a text."""
    reader = language.Codes()
    grams = {level: Counter() for level in range(1, 5)}
    for text in texts:
        for code in reader.of([text])[0].tolist():
            grams[4][code] += 1
    for level in (3, 2, 1):
        for code in grams[level + 1]:
            grams[level][code & ((1 << 16 * level) - 1)] += 1
    return grams


def brute_probability(grams, alphabet, code, level=4):
    if level == 0:
        return 1 / alphabet
    code &= (1 << 16 * level) - 1
    below = brute_probability(grams, alphabet, code, level - 1)
    own = {c: n for c, n in grams[level].items() if c >> 16 == code >> 16}
    if not own:
        return below
    ones = sum(n == 1 for n in grams[level].values())
    twos = sum(n == 2 for n in grams[level].values())
    discount = min(0.9, max(0.1, ones / max(1, ones + 2 * twos)))
    total = sum(own.values())
    return max(own.get(code, 0) - discount, 0) / total + discount * len(own) / total * below


def test_model_equals_plain_kneser_ney(spark):
    texts = {"aa": ["abba abc", "Cab a  bac!"], "bb": ["xyz abz zzz", "zyx"]}
    rows = [(i, t, name, None, None) for name in texts for i, t in enumerate(texts[name])]
    model = language.train_language_model(documents(spark, rows))
    reader = language.Codes()
    for i, name in enumerate(model.names):
        grams = brute_model(texts[name])
        alphabet = round(float(np.exp(-model.base[0])))
        for text in ["abba", "cab zz", "qq"]:
            codes = reader.of([text])[0]
            want = [np.log(brute_probability(grams, alphabet, c)) for c in codes.tolist()]
            assert np.allclose(model.log_probabilities(codes)[:, i], want, atol=1e-4)


def test_long_texts_are_scored_whole():
    reader = language.Codes()
    model = language.LanguageModel(["l"], [], np.array([-2.0]))
    model.levels = [language.Level(np.empty(0, np.uint32), np.empty((0, 1)), np.empty(0, np.uint32),
                                   np.empty((0, 1))) for _ in range(4)]
    entropy, lettered = model.cross_entropies(["ab " * 400_000, None, "", "12 3"], reader)
    assert entropy[0, 0] == pytest.approx(2.0) and lettered.tolist() == [True, False, False, False]


def test_held_out_languages(spark):
    found = language.op5_kneser_ney_language(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()
    both = found.merge(docs, on="doc_id")
    assert len(both) == len(docs) and found["score"].between(0, 1).all()
    out = both[both["held_out"]]
    assert (out["lang_pred"] == out["lang"]).mean() > 0.98


def test_calibration_covers_every_row(spark):
    """Bounds of rejection from all rows, each scored by a model of the other folds."""
    docs = documents(spark).filter("text IS NOT NULL AND lang IS NOT NULL").withColumn(
        "fold", F.pmod(F.xxhash64("doc_id", "text"), F.lit(8)))
    model = language.train_language_model(docs)
    own, reader = {name: [] for name in model.names}, language.Codes()
    for fold in range(8):
        counts = language.count_codes(docs.filter(F.col("fold") != fold), text="text", lang="lang")
        trial = language._built(counts, 64)
        rows = [(r["text"], r["lang"]) for r in docs.filter(F.col("fold") == fold).collect()]
        entropies, lettered = trial.cross_entropies([text for text, _ in rows], reader)
        for (_, name), values in zip([r for r, has in zip(rows, lettered) if has], entropies[lettered]):
            own[name].append(values[trial.names.index(name)])
    assert sum(map(len, own.values())) > 50
    want = [np.mean(own[name]) + 4 * max(np.std(own[name]), 0.02) for name in model.names]
    assert np.allclose(model.worst, want, atol=1e-5)


def test_detection_of_awkward_rows(spark):
    model = language.train_language_model(documents(spark))
    found = {r["doc_id"]: r["d"] for r in with_clashes(documents(spark)).select(
        "doc_id", language.detect(model)("text").alias("d")).collect()}
    for empty in (200, 201, 202):
        assert (found[empty]["lang"], found[empty]["score"], found[empty]["rejected"]) == ("und", 0.0, True)
    assert {r["lang"] for r in found.values()} <= {"xx", "yy", "und"}
    assert found[207]["lang"] in ("xx", "yy") and found[207]["rejected"]


def test_no_language_is_learned_from_nothing(spark):
    model = language.train_language_model(documents(spark, []))
    row = documents(spark, [(1, "text", None, None, 1)]).select(language.detect(model)("text").alias("d"))
    assert row.first()["d"]["lang"] == "und"


def test_any_number_of_languages(spark):
    """Seventy languages in groups of 64 are told apart, and like a single group tells them."""
    rows = [(i, f"{chr(0x4E00 + i)}{chr(0x4E01 + i)} " * 9, f"l{i:02}", None, None) for i in range(70)]
    docs = documents(spark, rows)
    models = [language.train_language_model(docs, together=n) for n in (64, 100)]
    assert len(models[0].names) == 70 and len(models[0].parts) == 2 and not models[1].parts
    codes = language.Codes().of([rows[3][1], rows[69][1]])[0]
    assert np.allclose(*[m.log_probabilities(codes) for m in models], atol=1e-6)
    found = docs.select("lang", language.detect(models[0])("text").alias("d")).collect()
    assert all(r["d"]["lang"] == r["lang"] for r in found)


def test_more_codes_than_any_fixed_number_of_slots(spark):
    """Over 2^20 distinct codes, each answered as plain dictionaries answer it."""
    rng = random.Random(5)
    text = "".join(rng.choices([chr(0x4E00 + i) for i in range(9000)], k=1_100_000))
    model = language.train_language_model(documents(spark, [(1, text, "zz", None, None)]))
    assert len(model.levels[3].codes) > 2**20
    grams = brute_model([text])
    alphabet = round(float(np.exp(-model.base[0])))
    codes = language.Codes().of([text[500:503] + "\u4e01\u4e02\u9fa5"])[0][-3:]
    want = [np.log(brute_probability(grams, alphabet, c)) for c in codes.tolist()]
    assert np.allclose(model.log_probabilities(codes)[:, 0], want, atol=1e-4)


def test_letters_beyond_the_first_plane_stay_apart():
    reader = language.Codes()
    one, other, symbol, gap = (reader.of([t])[0].tolist() for t in (
        "a\U00020041b", "a\U00020100b", "a\U0001f600b", "a b"))
    assert len(one) == 4 and len(set(one) & set(other)) == 2 and symbol == gap
    assert reader.of(["\U00020041", "\U0001f600"])[2].tolist() == [True, False]


def test_stretches_carry_what_comes_before(monkeypatch):
    texts = ["Ab  c!! d\U00020041 e\n\n\n\n\nfgh \u0130x ", "\U00020041\U00020100b\U0001f600\U0001f601c", None, "", "zz\x01z", "... ..", "  a"]
    reader = language.Codes()
    whole = [reader.of([t or ""])[0].tolist() for t in texts]
    for size in (1, 2, 3, 5, 100):
        monkeypatch.setattr(language, "_STRETCH", size)
        codes = [[] for _ in texts]
        for rows, parts, heads in language._stretches(texts):
            found, owner, _ = reader.of(parts, heads)
            for code, part in zip(found.tolist(), owner.tolist()):
                codes[rows[part]].append(code)
        assert codes == whole


# ---- quality ----------------------------------------------------------------


def test_held_out_quality(spark):
    found = quality_zstd.op7_compression_quality(spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    both = found.merge(labels, on="doc_id")
    out = both[both["held_out"]]
    assert len(found) == 1000 and found["score"].between(0, 1).all()
    assert ((found["score"] >= 0.5) == (found["predicted"] == 1)).all()
    assert (out["predicted"] == out["quality"]).mean() > 0.93


def quality_rows(n=120):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta"]
    good = [" ".join(rng.choices(words, k=60)) for _ in range(n)]
    bad = [" ".join(w + rng.choice("#%$*") * 3 for w in rng.choices(words, k=60)) for _ in range(n)]
    return good, bad


def test_scores_follow_the_labels_and_take_awkward_texts(spark):
    good, bad = quality_rows()
    rows = [(t, 1) for t in good] + [(t, 0) for t in bad] + [(None, 1), ("", 0), ("x", None), ("y", 7)]
    model = quality_zstd.fit_compression_model(
        spark.createDataFrame(rows, "text string, label int"))
    scored = with_clashes(documents(spark)).withColumn(
        "s", quality_zstd.quality_score(model, F.col("text"))).toPandas()
    assert scored["s"].between(0, 1).all() and len(scored) == len(awkward())
    blank = scored[scored["doc_id"].isin([200, 201])]["s"]
    assert blank.nunique() == 1
    texts = spark.createDataFrame([(t, 1) for t in good[:20]] + [(t, 0) for t in bad[:20]], "text string, y int")
    held = texts.withColumn("s", quality_zstd.quality_score(model, F.col("text"))).toPandas()
    assert ((held["s"] >= 0.5) == (held["y"] == 1)).mean() > 0.95
    kept = quality_zstd.reject_low_quality(texts, model)
    assert kept.columns == ["text", "y"] and kept.filter("y = 1").count() >= 19


def test_dictionaries_learn_from_whole_texts(spark):
    """What tells the sides apart comes after the first 4,500 characters only."""
    rng = random.Random(4)
    words = [" ".join(rng.choices("abcdefgh", k=5)).replace(" ", "") for _ in range(400)]

    def text(end):
        return " ".join(rng.choices(words, k=750))[:4500] + f" {end} ".join(rng.choices(words, k=120))

    rows = [(text("WHOLESOME-ENDING"), 1) for _ in range(80)] + [
        (text("JUNK#%$*JUNK#%$*"), 0) for _ in range(80)]
    model = quality_zstd.fit_compression_model(spark.createDataFrame(rows, "text string, label int"))
    assert b"JUNK#%$*JUNK#%$*" in model.bad and b"JUNK#%$*" not in model.good
    assert b"WHOLESOME-ENDING" in model.good and b"WHOLESOME" not in model.bad
    again = [(text("WHOLESOME-ENDING"), 1) for _ in range(20)] + [
        (text("JUNK#%$*JUNK#%$*"), 0) for _ in range(20)]
    found = spark.createDataFrame(again, "text string, y int").withColumn(
        "s", quality_zstd.quality_score(model, F.col("text"))).toPandas()
    assert ((found["s"] >= 0.5) == (found["y"] == 1)).mean() > 0.9


def test_one_sided_and_empty_labels(spark):
    docs = documents(spark)
    for rows, prior in (([], 0.5), ([("good", 1)], 1.0), ([("bad", 0)], 0.0)):
        model = quality_zstd.fit_compression_model(spark.createDataFrame(rows, "text string, label int"))
        scores = docs.select(quality_zstd.quality_score(model, F.col("text"))).distinct().collect()
        assert [row[0] for row in scores] == [prior]


# ---- rules ------------------------------------------------------------------


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
               for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_statistics_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [row[1] for row in awkward()] + [
        " ".join(rng.choices("ab", k=rng.randint(0, 40))) for _ in range(60)] + [
        "a\nb\na\n \n \nb\t\na", "x y z x y z x", "a a a a", "a a a", "| <b> & 50% $5 #1 *",
        "one\x0btwo\x0cthree\rfour", " lead and trail "]
    frame = with_clashes(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"))
    found = rules.text_statistics(frame.withColumn("n_words", F.lit("own"))).toPandas()
    for row in found.itertuples():
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert got == brute_statistics(texts[row.i]), repr(texts[row.i])
    assert set(found["key"]) == {"own key"}


def test_rules_are_learned_and_ordered(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(3000):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((a, b, c, a > 0.8 or (b <= 0.3 and c > 0.6), rng.random() < 0.3))
    table = WorkTables(spark).write(
        spark.createDataFrame(rows, "a double, b double, c double, bad boolean, prune boolean"), "rates")
    learned = rules.learn_rules(table, ["a", "b", "c"], prune=F.col("prune"))
    judged = table.select("bad", rules.verdict(learned).alias("kept"),
                          rules.rule_number(learned).alias("rule")).toPandas()
    assert (judged["kept"] == ~judged["bad"]).mean() > 0.95
    assert ((judged["rule"] == 0) == judged["kept"]).all() and len(learned) >= 2
    assert all(1 <= len(r.conditions) <= 3 for r in learned)


@pytest.mark.parametrize("rows", [[], [(0.5, True, False)] * 20, [(0.5, False, True)] * 20,
                                  [(None, None, False)] * 5, [(0.5, True, True), (0.5, False, False)] * 20])
def test_nothing_to_learn_gives_no_wrong_rules(spark, rows):
    table = spark.createDataFrame(rows, "a double, bad boolean, prune boolean")
    assert rules.learn_rules(table, ["a"], prune=F.col("prune")) == []


def test_rule_query(spark):
    found = rules.op8_decision_list(spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().set_index("doc_id")
    for row in found.itertuples():
        stats = brute_statistics(docs.loc[row.doc_id, "text"])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == stats
        assert row.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert not (row.base_failed and row.kept)
    both = found.merge(labels, on="doc_id")
    assert both[both["quality"] == 1]["kept"].mean() > 0.93
    assert both[both["quality"] == 0]["kept"].mean() < 0.1


# ---- lines ------------------------------------------------------------------


def brute_lines(rows, ratio, least):
    totals = Counter(host for _, _, host in rows)
    bare = lambda line: line.strip(" \t\r\x0b\x0c")
    pages = Counter((host, line) for _, text, host in rows
                    for line in {bare(x) for x in (text or "").split("\n")} if line)
    out = []
    for doc, text, host in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not bare(x) or not (
            pages[host, bare(x)] >= least and pages[host, bare(x)] > ratio * totals[host])]
        out.append((doc, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ratio", [0.05, 0.5])
def test_lines_equal_brute_force(spark, ratio):
    rng = random.Random(11)
    pool = [f"line {i}" for i in range(40)] + ["menu", " menu\t", "menu", "", "  ", "footer\r"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 8))) if i % 9 else None,
             rng.choice(["h", "h", "h", "g", None])) for i in range(200)]
    rows += [(900, "menu\nown text", "h")] * 3 + [(901, "menu", "alone"), (None, "menu\nx", "h")]
    frame = with_clashes(spark.createDataFrame(rows, "doc long, text string, site string"))
    found = line_dedup.drop_boilerplate(frame, host="site", ratio=ratio, least_pages=3)
    assert set(found.columns) == {*frame.columns, "n_dropped"}
    got = sorted(((r["doc"], r["text"], r["n_dropped"]) for r in found.collect()), key=repr)
    assert got == brute_lines(rows, ratio, 3)


def test_no_pages(spark):
    assert line_dedup.drop_boilerplate(documents(spark, []), host="source").count() == 0


def test_folds_take_null_ids(spark):
    frame = spark.createDataFrame([(None,), (5,)], "doc_id long").select(crc_fold("doc_id", 3))
    assert frame.collect()[0][0] == -1
