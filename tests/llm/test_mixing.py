"""Targets against repeated sharing, blocks and words taken against their definition."""

from collections import Counter, defaultdict

import pytest
from helpers import corpus, empty, words

from gaugeworks.llm import mixing


def plain_targets(sizes):
    """Share by weight, stop at three times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5000, None: 3}, {"a": 100}, {None: 7, "b": 0}, {"x": 5, "é": 500, "😀": 20, "y": 1, "z": 9000}, {"a": 0},
])
def test_targets(spark, sizes):
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = plain_targets(sizes)
    assert {r.source: r.target for r in got} == {s: pytest.approx(t) for s, t in want.items()}


def test_words_taken(documents):
    rows = mixing.mixed(documents).collect()
    size = {id(r): len(words(r[1])) for r in corpus()}
    by_source = defaultdict(int)
    for r in corpus():
        by_source[r[3]] += len(words(r[1]))
    want = plain_targets(by_source)
    assert Counter((r.doc_id, r.source, r.size, r.source_size) for r in rows) == Counter(
        (r[0], r[3], len(words(r[1])), by_source[r[3]]) for r in corpus()
    )
    assert size
    taken = defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 4 * mixing.BLOCK
    assert Counter(map(tuple, mixing.mixed(documents).collect())) == Counter(map(tuple, rows))


def test_slots_take_every_block_alike(spark):
    plan = mixing.targets(spark.createDataFrame([("a", 6400), ("b", 640), ("c", 64_000)], "source string, source_size long"))
    size = {r.rank: r.source_size for r in plan.collect()}
    want = {r.rank: r.target for r in plan.collect()}
    rows = mixing.slots(plan, block=64, size=100).collect()
    per_shard, times = Counter(), Counter()
    for r in rows:
        per_shard[r.shard, r.rank] += 1
        times[r.rank, r.block] += 1
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    # Shards are full but for the last, and draw: their counts vary as those of a multinomial draw do.
    total, shards = sum(want.values()), max(s for s, _ in per_shard)
    for shard in range(shards):
        assert sum(per_shard[shard, k] for k in size) == 100
    for rank in size:
        p = want[rank] / total
        seen = [per_shard[s, rank] - 100 * p for s in range(shards)]
        spread = sum(x * x for x in seen) / shards / (100 * p * (1 - p))
        assert 0.2 < spread < 5
    # Totals equal the targets to a block, and every block is taken alike.
    for rank in size:
        assert sum(n for (_, k), n in per_shard.items() if k == rank) == round(want[rank] / 64)
        blocks = -(-size[rank] // 64)
        counts = [times[rank, b] for b in range(blocks)]
        assert max(counts) - min(counts) <= 1 and set(b for k, b in times if k == rank) <= set(range(blocks))


def test_small_buckets(spark, documents):
    """Sources of many buckets: the same sums, and every block lies within its bucket."""
    rows = mixing.mixed(documents, block=16, bucket_words=500).collect()
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        size[r.source] += r.size
    assert len(rows) == len(corpus()) and sum(size.values()) == sum(len(words(r[1])) for r in corpus())
    for s, t in target.items():
        # Blocks at the end of a bucket are shorter.
        assert abs(taken[s] - t) <= 0.1 * t + 4 * 16


def test_mix_holds_the_words_of_every_slot(spark, documents, tmp_path):
    got = mixing.mixed(documents, folder=f"{tmp_path}/mix").collect()
    mix = spark.read.parquet(f"{tmp_path}/mix").collect()
    assert Counter((r.shard, r.slot, r.text) for r in mixing.mixture(documents).collect()) == Counter((r.shard, r.slot, r.text) for r in mix)
    for shard in {r.shard for r in mix}:
        used = sorted(r.slot for r in mix if r.shard == shard)
        assert used == list(range(len(used)))
    # Each block has one text; the blocks of a source, end to end, are its texts, end to end.
    texts, parts, source = {}, {}, {}
    named = {r.rank: r.source for r in mixing.mixture(documents).select("rank", "source").distinct().collect()}
    for r in mix:
        assert texts.setdefault((r.rank, r.block), r.text) == r.text and sum(p.words for p in r.parts) == len(words(r.text))
        source[r.rank] = named[r.rank]
        parts[r.rank, r.block] = r.parts
    whole = 0
    for rank, name in source.items():
        want = Counter(tuple(words(r[1])) for r in corpus() if r[3] == name and words(r[1]))
        size = sum(len(t) * n for t, n in want.items())
        blocks = -(-size // mixing.BLOCK)
        if any((rank, b) not in texts for b in range(blocks)):
            continue
        whole += 1
        assert all(len(words(texts[rank, b])) == min(mixing.BLOCK, size - b * mixing.BLOCK) for b in range(blocks))
        line = [w for b in range(blocks) for w in words(texts[rank, b])]
        starts = sorted({p.start for b in range(blocks) for p in parts[rank, b]})
        assert Counter(tuple(line[a:b]) for a, b in zip(starts, [*starts[1:], size])) == want
    assert whole > 0
    assert sum(r.taken for r in got) == sum(len(words(r.text)) for r in mix)


def test_empty(spark):
    assert mixing.mixed(empty(spark)).count() == 0
    assert mixing.mixture(empty(spark)).count() == 0
    only = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert sorted(map(tuple, mixing.mixed(only).collect())) == [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)]
