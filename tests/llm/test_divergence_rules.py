import math
import random
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from docshred.llm.divergence_rules import base_measures, js_distance, judge
from tests.llm.fixtures import documents, empty, frame, prose


def slow_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    seen = Counter(tuple(words[k:k + 5]) for k in range(n - 4))
    covered = {j for k in range(n - 4) if seen[tuple(words[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), n < 10 or 100 * len(covered) > 20 * n)


def test_base_measures_against_plain_counting(spark):
    df = frame(spark)
    got = [tuple(r) for r in base_measures(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    assert sorted(got, key=repr) == sorted(((r["doc_id"], *slow_base(r["text"])) for r in df.collect()), key=repr)


def test_distance_against_the_formula(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = math.sqrt(sum(a * math.log2(a / c) for a, c in zip(p, m) if a) / 2
                     + sum(b * math.log2(b / c) for b, c in zip(q, m) if b) / 2)
    row = spark.range(1).select(js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q))).alias("d"),
                                js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, p))).alias("z")).first()
    assert row["d"] == pytest.approx(want) and row["z"] == 0


def test_divergent_texts_are_rejected_and_short_ones_not_judged(spark):
    rows = [(i, "The cat of the house is in the garden and it was there. " * 1 + " ".join(
        f"plain{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)} of the" for k in range(60)), "en", "", 1) for i in range(30)]
    rows.append((90, " ".join(f"{k}#{k}%{k * 7}&" for k in range(200)), "en", "", 1))
    rows.append((91, " ".join(f"{k}#" for k in range(12)), "en", "", 1))
    rows.append((92, rows[0][1], None, "", 1))
    got = {r["doc_id"]: r for r in judge(frame(spark, rows)).collect()}
    assert not got[90]["kept"] and not got[90]["base_failed"]
    assert got[91]["class_distance"] is None and got[91]["kept"]
    assert got[92]["kept"] and all(got[i]["kept"] for i in range(30))


def test_main_path_has_no_python(spark):
    plan = judge(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_windows_sort_without_a_comparator_per_pair(spark):
    """array_sort evaluates a lambda for every pair that it compares."""
    plan = base_measures(frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_awkward_rows(spark):
    assert judge(frame(spark)).count() == frame(spark).count()
    assert judge(empty(spark)).count() == 0


def test_rare_languages_have_their_own_reference_and_unknown_ones_none(spark):
    en = "The cat of the house is in the garden and it was there " + " ".join(
        f"plain{chr(97 + k % 26)}{chr(97 + k // 26)} of the" for k in range(60))
    ru = " ".join(f"дом{chr(0x430 + k % 32)}{chr(0x430 + k // 3)} на и" for k in range(80))
    rows = [(i, f"{en} number{i}", "en", "", 1) for i in range(2000)]
    rows += [(3000 + i, f"{ru} номер{i}", "ru", "", 1) for i in range(15)]  # under 1% of the documents
    rows += [(4000, ru, None, "", 1), (4001, ru, "bg", "", 1), (4002, " ".join(f"{k}#{k}%{k * 7}&" for k in range(200)), "ru", "", 1)]
    got = {r["doc_id"]: r for r in judge(frame(spark, rows)).where("doc_id >= 3000").collect()}
    assert all(got[3000 + i]["kept"] and got[3000 + i]["class_distance"] < 0.3 for i in range(15))
    assert all(got[i]["kept"] and got[i]["class_distance"] is None and got[i]["word_distance"] is None for i in (4000, 4001))
    assert not got[4002]["kept"] and not got[4002]["base_failed"]
    alone = {r["doc_id"]: r for r in judge(frame(spark, [r for r in rows if r[2] == "ru"])).collect()}
    assert all(alone[i]["kept"] == got[i]["kept"] and abs(alone[i]["class_distance"] - got[i]["class_distance"]) < 1e-12
               for i in alone)


def slow_judge(rows):
    """(id, class distance, word distance, kept) of every row by plain counting."""
    def classes(text):
        out, left = [], text
        for pattern in ("[a-z]", r"[\x20\x09-\x0D]", r"(?![A-Z])[\p{L}\p{M}]", "[A-Z]", r"[.,;:!?'\"()-]", r"\p{N}"):
            rest = regex.sub(pattern, "", left)
            out.append(len(left) - len(rest))
            left = rest
        return [*out, len(left)]

    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text)

    def distance(p, q):
        total = 0.0
        for a, b in zip(p, q, strict=True):
            for x in (a, b):
                total += x * math.log2(2 * x / (a + b)) / 2 if x > 0 else 0
        return math.sqrt(max(total, 0))

    def shares(counts):
        return [c / max(sum(counts), 1) for c in counts]

    refs = {}
    for lang in {r[2] for r in rows if r[2] is not None}:
        texts = [r[1] or "" for r in rows if r[2] == lang]
        total = [sum(c) for c in zip(*map(classes, texts))]
        if sum(total) >= 10_000:
            count = Counter(w for t in texts for w in words(t))
            n = sum(count.values())
            refs[lang] = shares(total), {w: c / n for w, c in sorted(count.items()) if c >= 0.01 * n}
    out = []
    for i, text, lang, *_ in rows:
        text, by_class, by_word = text or "", None, None
        if lang in refs:
            mine, common = Counter(words(text)), refs[lang][1]
            n = sum(mine.values())
            if len(text) >= 200:
                by_class = distance(shares(classes(text)), refs[lang][0])
            if n >= 60 and common:
                hits = [mine[w] for w in common]
                by_word = distance([h / n for h in [*hits, n - sum(hits)]], [*common.values(), 1 - sum(common.values())])
        out.append((i, by_class, by_word, not slow_base(text)[-1] and (by_class or 0) <= 0.3 and (by_word or 0) <= 0.35))
    return out


def test_references_and_verdicts_against_plain_counting(spark):
    rng = random.Random(14)
    rows = documents()
    usual = "notwithstanding the committee's considerations of a proposal"  # long words that are common
    for i in range(40):
        words = usual.split() * 12 + prose(rng, 12).split()
        rng.shuffle(words)
        rows.append((100 + i, " ".join(words), "xx", "", 1))
    rows += [(200, prose(rng, 40), "xx", "", 1), (201, " ".join(f"{k}#{k}%{k * 7}&" for k in range(200)), "xx", "", 1),
             (202, "ДОМ на и 日本 ① " * 30 + usual, "xx", "", 1), (203, usual * 9, "few", "", 1), (204, usual, None, "", 1)]
    want = slow_judge(rows)
    got = [(r["doc_id"], r["class_distance"], r["word_distance"], r["kept"]) for r in judge(frame(spark, rows)).collect()]
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert (a[0], a[3]) == (b[0], b[3])
        for x, y in zip(a[1:3], b[1:3], strict=True):
            assert x == (None if y is None else pytest.approx(y, abs=1e-9))
    verdict = {r[0]: r for r in want}
    assert verdict[100][3] and not verdict[201][3]
    assert not verdict[200][3] and verdict[200][1] < 0.3 and verdict[200][2] > 0.35  # lacks the long common words
