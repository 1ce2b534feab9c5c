"""Line rules and measures against plain recounts."""

import random
import re
from collections import Counter

import duckdb
from hypothesis import given, settings, strategies as st

from farelens.llm import quality, registry

GOOD = "The first line says something new, at some length, about the weather of the day."


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    count = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


@settings(max_examples=200, deadline=None)
@given(st.text("ab é \n\t|%.", max_size=60))
def test_measures_match_a_recount(text):
    assert tuple(quality.judge_text(text)[:5]) == brute(text)


def test_lines():
    fails = lambda x: quality.line_fails(x.encode(), x.encode().split())
    assert not fails(GOOD) and not fails("Les.") and not fails("Well said!") and not fails("fin »")
    assert fails("a | b | c | d") and fails("one%%% two*** three###") and fails("NO!! WAY!! sir.")
    assert fails("Home News") and fails("a list of words and no more")
    assert fails("All Rights RESERVED by us.") and fails("spam " * 9 + "spam.")


def test_rules_do_not_depend_on_the_length_of_a_line():
    rng = random.Random(3)
    prose = [f"w{rng.randrange(4000)}" for _ in range(20_000)]
    prose[9::10] = [x + "." for x in prose[9::10]]
    found = quality.judge_text(" ".join(prose))
    assert len(set(prose)) * 3 <= len(prose)
    assert found.kept and not found.base_failed and found.n_lost_words == 0
    once = " ".join(prose[:300]) + " See the privacy policy and the terms of use there."
    assert quality.judge_text(once).n_lost_words == 0
    assert quality.judge_text("By using it you accept our terms of use.").n_lost_words == 9
    fails = lambda x: quality.line_fails(" ".join(x).encode(), " ".join(x).encode().split())
    assert fails(["spam,", "ham"] * 10_000) and fails(prose[:500] * 40)
    assert fails(prose[:9000] + ["spam,", "ham"] * 5000)


def slow_repeats(words):
    """The repetition rule, stretch by stretch."""
    n = len(words)
    if n < 10 or len(set(words)) * 3 > n:
        return False
    size = min(n, quality.STRETCH)
    inside = {j for i in range(n - size + 1) if len(set(words[i:i + size])) * 3 <= size
              for j in range(i, i + size)}
    windows = [tuple(words[i:i + 13]) for i in range(n - 12)]
    count = Counter(windows)
    twice = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 13)}
    return 2 * len(inside) >= n or 2 * len(twice) > n


def test_repetition_is_one_rule_for_all_lengths():
    rng = random.Random(5)
    for n in [*range(9, 30), *range(195, 206), 290, 401, 600, 900]:
        for pool in (2, 5, 12, 40, 66, 90, 150):
            words = [b"w%d" % rng.randrange(pool) for _ in range(n)]
            if rng.random() < 0.3:
                words[:n // 2] = [b"v%d" % i for i in range(n // 2)]
            if rng.random() < 0.3:
                words = words[:n // 3] * 3
            assert quality.repeats_itself(words) == slow_repeats(words), (n, pool)
    line = [b"w%d" % rng.randrange(60) for _ in range(500)]  # never passes once it failed
    verdicts = [quality.repeats_itself(line[:n]) for n in range(1, 500)]
    assert verdicts.index(True) < 200 and all(verdicts[verdicts.index(True):])
    probe = [b"w%d" % (i % 64) for i in range(200)]
    assert quality.repeats_itself(probe) and quality.repeats_itself(probe + [b"new"])


def test_sql_says_the_same_of_long_lines_and_phrases(spark):
    rng = random.Random(6)
    draw = lambda n, pool: [f"w{rng.randrange(pool)}" for _ in range(n)]
    texts = [" ".join(draw(n, pool)) + "." for n in (60, 199, 200, 201, 260, 700)
             for pool in (20, 64, 90, 200)]
    texts += [" ".join(draw(300, 150) * 3) + ".", " ".join(draw(500, 170) + ["spam,", "ham"] * 150),
              " ".join(draw(60, 900)) + ". See the privacy policy.", "Our terms of use.\n" * 2,
              "By using it you accept our terms of use. " + GOOD, None, "", GOOD * 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {tuple(r) for r in quality.judge(docs).drop("clean_text").collect()}
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    result = con.execute(registry.SQL["op10_quality_rules"])
    places = [[c[0] for c in result.description].index(c) for c in (
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_lost_words", "kept")]
    assert found == {tuple(r[i] for i in places) for r in result.fetchall()}


def test_documents(spark):
    clean = "\n".join(" ".join(f"w{i}{j}é" for j in range(11)) + "." for i in range(6))
    junk = "\n".join(" | ".join(f"w{i}{j}" for j in range(9)) for i in range(9))
    rows = [(1, clean + "\nHome", "a", 3), (2, junk, "a", 3), (3, None, None, None),
            (4, "", "b", 0), (None, clean, None, 5), (5, clean * 300, "c", 9), (1, clean, "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_chars long")
    found = quality.judge(docs).collect()
    assert [r.kept for r in found] == [True, False, False, False, True, False, True]
    assert found[0].n_lost_words == 1 and found[4].doc_id is None
    cleaned = quality.clean(docs)
    assert cleaned.schema == docs.schema
    assert [tuple(r) for r in cleaned.collect()] == [
        (1, clean, "a", len(clean)), (None, clean, None, 5), (1, clean, "a", 3)]
    assert quality.judge(docs.limit(0)).count() == 0 and quality.clean(docs.limit(0)).count() == 0
