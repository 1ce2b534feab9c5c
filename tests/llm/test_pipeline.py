"""The pipeline's stages one by one against brute-force versions on a small table."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from farelens.llm.quality import judge_text
from test_minhash import brute_groups
from test_substrings import brute as brute_substrings

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    lines = lambda n: [" ".join(word() for _ in range(10)) + "." for _ in range(n)]
    passage = lines(4)
    texts = []
    for _ in range(30):
        texts.append("\n".join(lines(rng.randrange(6, 14)) + passage * (rng.random() < 0.3)))
    texts += [texts[3].replace("\n", " \n"), texts[4], texts[5].replace("a", "b", 1),
              texts[6] + "\nHome\nNews", "too short.", None, "", "w | x | y\n" * 60]
    rows = [(i * 3 % 101, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, texts[1], None, None, 1)]


def test_stages(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        kept[name] = [tuple(r)[:2] for r in docs.collect()]

    found = [(i, judge_text(t)) for i, t, *_ in rows]
    expected = [(i, j.text) for i, j in found if j.kept]
    assert sorted(kept["quality_rules"], key=str) == sorted(expected, key=str)

    firsts = {}
    for i, t in sorted(expected, key=lambda r: (r[0] is None, r[0])):
        firsts.setdefault(" ".join(t.split()), (i, t))
    expected = list(firsts.values())
    assert sorted(kept["exact_dedup"], key=str) == sorted(expected, key=str)

    groups = brute_groups(expected)
    expected = [(i, t) for i, t in expected if i is None or groups[i] == i]
    assert sorted(kept["near_dedup"], key=str) == sorted(expected, key=str)

    words = list(brute_substrings(expected))
    changed = [(i, " ".join(w) if len(w) < n else t) for (i, t), (n, w) in zip(expected, words)]
    assert changed != expected
    assert sorted(kept["substring_dedup"], key=str) == sorted(changed, key=str)

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in changed}
    summed = {}
    for p in pieces:
        summed[p.doc_id] = summed.get(p.doc_id, 0) + p.length
        assert p.doc_tokens == tokens[p.doc_id]
    assert summed == tokens


def test_run_on_the_smallest_tables(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
