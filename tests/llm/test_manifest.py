"""The Merkle manifest against plain Python, and the arithmetic of its layout."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.llm.manifest import FAN_OUT, LEVELS, address, block_start, dataset_manifest, leaf_hash, levels_of, nodes_of, tree_roots, verify


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(leaves):
    """All levels, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, i):
    path = []
    for level in levels[:-1]:
        begin = i // 16 * 16
        path.append((level[begin:i], level[i + 1 : begin + 16]))
        i //= 16
    return path


def expected(rows):
    """``(doc, leaf, subroot, root, proof, folded, verified)`` of rows (doc, group, leaf, claim)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    trees = {}
    for name, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[name] = tree_of([r[2] for r in members])
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    top = tree_of([trees[n][-1][0] for n in names])
    root, out = top[-1][0], []
    for at, name in enumerate(names):
        for i, (doc, _, leaf, claim) in enumerate(groups[name]):
            path = path_of(trees[name], i) + path_of(top, at)
            folded = claim
            for left, right in path:
                folded = sha(*left, folded, *right)
            out.append((doc, leaf, trees[name][-1][0], root, sha(*(h for a, b in path for h in a + b)), folded, folded == root))
    return sorted(out, key=str)


def got(spark, rows, order=("doc",)):
    data = [(doc, group, bytes.fromhex(leaf), claim and bytes.fromhex(claim), 1, "x") for doc, group, leaf, claim in rows]
    frame = spark.createDataFrame(data, "doc long, kind string, leaf binary, claimed binary, size int, path string").repartition(3)
    found = verify(dataset_manifest(frame, "kind", list(order)), "claimed").withColumn("leaf", F.lower(F.hex("leaf")))
    columns = ("doc", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=str)


def case(name):
    ids = [*range(1, 20), None, None, 7, 7]
    if name == "small":  # nulls, repeated rows, unlike rows of one id, a lone leaf, an empty name, a name of letters beyond ASCII
        rows = [(i, g, f"t{k % 21}") for g in (None, "", "a", "é", "z") for k, i in enumerate(ids)] + [(5, "lone", "x")]
    elif name == "groups":  # more groups than a node has children, most of one leaf
        rows = [(i, f"g{i % 300}", f"t{i}") for i in range(450)]
    else:  # one group of more leaves than a block has
        rows = [(i, "hot", f"t{i}") for i in range(4096 * 2 + 17)] + [(i, "b", "t") for i in range(3)]
    return [(i, g, leaf_of(i, g, t), leaf_of(i, g, t + "!" if (i or 0) % 5 == 0 else t)) for i, g, t in rows]


@pytest.mark.parametrize("name", ["small", "groups", "hot"])
def test_against_plain_python(spark, name):
    rows = case(name)
    assert got(spark, rows) == expected(rows)


def test_empty_and_single(spark):
    assert got(spark, []) == []
    rows = [(1, "a", leaf_of(1), leaf_of(1))]
    assert got(spark, rows) == expected(rows) == [(1, leaf_of(1), leaf_of(1), leaf_of(1), sha(), leaf_of(1), True)]


def test_null_claim_is_not_verified(spark):
    (row,) = got(spark, [(1, "a", leaf_of(1), None)])
    assert row[-1] is False


def test_leaf_hash(spark):
    rows = spark.createDataFrame([(1, "é", None), (None, "", 2.5)], "a long, b string, c double")
    found = [r[0] for r in rows.select(F.lower(F.hex(leaf_hash(F.col("a"), F.col("b"), F.col("c"))))).collect()]
    assert found == [sha("1:1", "2:é", "-"), sha("-", "0:", "3:2.5")]


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_holds_every_node_once(levels):
    places = [address(levels, depth, i) for depth in range(levels) for i in range(FAN_OUT**depth)]
    assert sorted(places) == list(range(nodes_of(levels)))


@pytest.mark.parametrize("levels", [2, 3, 4, 5, 6, 7, 8, 9, 12])
def test_blocks_lie_in_one_piece(levels):
    """A node's address is its block's begin and its address in the block, at every tier."""
    size = FAN_OUT ** (levels - 1)
    assert levels_of(size) == levels and levels_of(size - 1) == levels and levels_of(size + 1) == levels + 1
    for tier in range(-(-levels // LEVELS)):
        blocks = FAN_OUT ** (levels - min(levels, LEVELS * (tier + 1)))
        for block in {0, blocks // 2, blocks - 1}:
            start, own = block_start(size, tier, block)
            root_depth = levels - LEVELS * tier - own
            for depth in range(own):
                for i in {0, FAN_OUT**depth // 3, FAN_OUT**depth - 1}:
                    assert address(levels, root_depth + depth, block * FAN_OUT**depth + i) == start + address(own, depth, i)


def test_stored_nodes(spark):
    """Every stored tier holds the nodes of its blocks, and the roots are those of the trees."""
    rows = case("hot")
    data = [(doc, group, bytes.fromhex(leaf)) for doc, group, leaf, _ in rows]
    manifest = dataset_manifest(spark.createDataFrame(data, "doc long, kind string, leaf binary"), "kind", ["doc"])
    levels = tree_of([r[2] for r in sorted(r for r in rows if r[1] == "hot")])
    stored = {r.address: r.hash.hex() for tier in manifest.tiers for r in tier.where("tree = '=hot'").collect()}
    want = {address(5, 4 - up, i): h for up, level in enumerate(levels) for i, h in enumerate(level)}
    assert len(levels) == 5 and stored == want
    roots = {r.tree: r.hash.hex() for r in tree_roots(manifest.tiers).collect()}
    assert roots["=hot"] == levels[-1][0] and set(roots) == {"=hot", "=b"}
