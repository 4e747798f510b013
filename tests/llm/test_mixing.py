import re
from collections import Counter, defaultdict

from statlab.llm.mixing import mix, source_mixing, splitting_tree, take, targets


def want_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = float(sum(sizes.values())), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] < weight[s] * share}
        if not full:
            found |= {s: weight[s] * share for s in open_}
            break
        for s in full:
            found[s] = float(most * sizes[s])
            left -= found[s]
        open_ -= full
    return found


def test_targets_and_words(odd, odd_rows):
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    rows = source_mixing(odd).collect()
    assert len(rows) == len(odd_rows)
    want = want_targets(sizes)
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] and len(r["shards"]) == r["copies"]
        by[r["source_size"], round(r["target"], 6)].append(r)
    assert sorted(by) == sorted((sizes[s], round(want[s], 6)) for s in sizes)
    for (_, target), own in by.items():
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own) * 1.5
    assert sorted(map(str, source_mixing(odd.repartition(5)).collect())) == sorted(map(str, rows))


def test_a_capped_source_and_one_without_words(spark):
    rows = [(i, "w " * 10, "big") for i in range(400)] + [(i, "w w w", "tiny") for i in range(400, 405)] + [(500, None, "void")]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert target["tiny"] == 45.0 and taken["tiny"] == 45 and target["void"] == 0.0
    assert abs(taken["big"] - target["big"]) <= 10


def test_the_tree_halves_every_node(spark):
    blocks = spark.createDataFrame([("s" * (b % 3 + 1), b, c) for b in range(64) for c in (1, 2)], "source string, block int, copy int")
    dealt = splitting_tree(blocks, 8, seed=3).collect()
    assert Counter(r["shard"] for r in dealt) == {s: 16 for s in range(8)}
    assert len({(r["source"], r["block"], r["copy"]) for r in dealt}) == 128


def test_take_repeats_rows(odd):
    mixed = mix(odd)
    copies = {(r["doc_id"], r["text"]): r["copies"] for r in mixed.collect()}
    rows = take(mixed).collect()
    assert len(rows) == sum(r["copies"] for r in mixed.collect()) and {r["shard"] for r in rows} <= set(range(8))
    assert all(copies[r["doc_id"], r["text"]] > 0 for r in rows)


def test_empty_table(none):
    assert source_mixing(none).collect() == [] and targets(none.selectExpr("source", "1L AS size")).collect() == []
