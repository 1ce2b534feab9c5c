"""The mix against a plain version that deals one block after the other."""

import hashlib
import heapq
import random
import re
from collections import defaultdict

import pytest

from farelens.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, key string, copies int"


def deal(votes, seats):
    """Highest quotients, seat by seat."""
    heap = [(-v / 1, i, 0) for i, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    got = [0] * len(votes)
    for _ in range(seats if heap else 0):
        _, i, k = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-votes[i] / (2 * k + 3), i, k + 1))
    return got


def fill(sizes, weights, most):
    """Targets by sharing again until none is above its limit."""
    caps, full = [most * s for s in sizes], set()
    while True:
        left = sum(sizes) - sum(caps[i] for i in full)
        weighed = sum(w for i, w in enumerate(weights) if i not in full)
        found = [float(caps[i]) if i in full else left * w / weighed
                 for i, w in enumerate(weights)]
        above = {i for i, t in enumerate(found) if i not in full and t >= caps[i]}
        if not above:
            return found
        full |= above
        if len(full) == len(sizes):
            return [float(c) for c in caps]


def by_hand(rows, block, shard_words, seed=11, weights=(5, 2, 1), most=3):
    docs = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for d, t, s in rows]
    names = sorted({s for *_, s in docs}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, n, s in docs if s == name) for name in names]
    goals = fill(sizes, [weights[i % 3] for i in range(len(names))], most) if names else []
    quotas = deal(goals, (sum(sizes) + block // 2) // block)
    out = []
    for place, name in enumerate(names):
        cells = defaultdict(list)
        for d, n, s in docs:
            if s == name:
                key = int(hashlib.md5(f"{seed}:{'' if d is None else d}".encode())
                          .hexdigest()[:15], 16)
                cells[key % max(1, -(-sizes[place] // shard_words))].append(
                    (key, d is not None, d or 0, n))
        shards = sorted(cells)
        words = [sum(c[-1] for c in cells[s]) for s in shards]
        for shard, w, q in zip(shards, words, deal(words, quotas[place])):
            copies = min(most, q * block // w) if w else 0
            extra = (q * block - copies * w + block // 2) // block if copies < most else 0
            code = hashlib.md5(f"{seed}:{place}:{shard}".encode()).hexdigest()
            step = mixing.STEPS[int(code[:4], 16) % len(mixing.STEPS)]
            blocks = -(-w // block)
            hit = [(i * step + int(code[4:12], 16)) % blocks < extra for i in range(blocks)]
            assert sum(hit) == min(extra, blocks)
            at = 0
            for _, known, d, n in sorted(cells[shard]):
                out.append((d if known else None, n, sizes[place], goals[place],
                            copies * n + sum(hit[i // block] for i in range(at, at + n))))
                at += n
    return sorted(out, key=str)


def table(seed, n):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        source = pick.choice(["a", "a", "a", "a", "b", "é", "z", "Z", None, "", "a b"])
        rows.append((i, " ".join("w" * pick.randint(1, 3) for _ in range(
            int(pick.paretovariate(0.9)))), source))
    return rows + [(n, None, "a"), (n + 1, " \t\r\n", "only empty"), (n + 2, "x " * 40_000, "a"),
                   (0, "same id", "a"), (0, "same id", "a"), (None, "no id at all", "b")]


@pytest.mark.parametrize("block, shard_words", [(32, 1 << 22), (7, 900), (1, 50)])
def test_matches_the_plain_version(spark, block, shard_words):
    rows = table(block, 400)
    frame = spark.createDataFrame([(*r, -1, "clash", 9) for r in rows], SCHEMA)
    found = mixing.mix(frame, block=block, shard_words=shard_words)
    got = found.select("doc_id", "size", "source_size", "target", mixing.words_taken()).collect()
    want = by_hand(rows, block, shard_words)
    assert sorted(map(tuple, got), key=str) == want
    taken = defaultdict(int)
    for r in got:
        assert r[-1] <= 3 * r.size
        taken[r.source_size, r.target] += r[-1]
    if block == 32:
        assert all(abs(t - goal) <= block for (_, goal), t in taken.items())


def test_spans_lie_in_their_document_and_do_not_overlap(spark):
    frame = spark.createDataFrame(table(5, 100), "doc_id long, text string, source string")
    for row in mixing.mix(frame, block=3, shard_words=200).collect():
        at = 0
        for span in row.spans:
            assert span.start >= at and span.length > 0
            at = span.start + span.length
        assert at <= row.size


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "one", "a")],
                                  [(1, "", "a"), (2, "a b c " * 50, "b")]])
def test_small_tables(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame, block=2).select(
        "doc_id", "size", "source_size", "target", mixing.words_taken()).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows, 2, 1 << 22)


@pytest.mark.parametrize("seats", [0, 1, 3, 40, 1001])
def test_apportionment_is_that_of_dealing_seat_by_seat(spark, seats):
    pick = random.Random(seats)
    votes = [float(int(pick.paretovariate(0.4))) for _ in range(60)] + [0.0, 5.0, 5.0, 1e12]
    frame = spark.createDataFrame([(1, i, v, seats) for i, v in enumerate(votes)],
                                  "g int, i int, v double, seats long")
    got = {r.i: r.quota for r in mixing.apportion(frame, ["g"], ["i"], "v", "seats").collect()}
    assert [got[i] for i in range(len(votes))] == deal(votes, seats)


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame(table(1, 20), "doc_id long, text string, source string")
    plan = mixing.mix(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
