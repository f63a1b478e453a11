"""SimHash against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash

from distaff.llm.components import connected_components
from distaff.llm.simhash import BLOCK_BITS, _hook, fingerprint, keep_one, linked_fingerprints, near_duplicates, trie_pairs


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def digest(df):
    return sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in df.collect()), key=str)


SCHEMA = "doc_id bigint, text string, source string, component_id string"


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 300]))]
        rows += [(4 * i, " ".join(base)), (4 * i + 1, "\t".join(base).upper()), (4 * i + 2, " ".join(base[:-1] + ["x"]))]
    rows += [(900, ""), (901, None), (902, " \n"), (None, "a b c d"), (903, "a b c d"), (7, "é É x"), (7, "é É x")]
    rows += [(None, "only null ids here now"), (950, " ".join(words * 40))]
    df = spark.createDataFrame([(d, t, "s", "clash") for d, t in rows], SCHEMA)
    assert digest(near_duplicates(df)) == plain_components(rows)


@pytest.mark.parametrize("split", [False, True])
def test_trie_finds_every_pair(split):
    rng = np.random.default_rng(3)
    head = np.uint64(0xABCD) << np.uint64(48)
    base = rng.integers(0, 2**48, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 48, (300, 4)).astype(np.uint64)
    every = np.unique(np.concatenate([base, base ^ flips[:, 0], base ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2], base ^ np.bitwise_xor.reduce(flips, axis=1)]) | head)
    left, right = (every[::2], every[1::2]) if split else (every, None)
    found = {(int(a), int(b)) for i, j in trie_pairs(left, right, BLOCK_BITS, 3) for a, b in zip(i, j)}
    other = right if split else left
    wanted = {(i, j) for i, a in enumerate(left) for j, b in enumerate(other) if (split or i < j) and int(a ^ b).bit_count() <= 3}
    assert found == wanted and wanted


def test_large_sub_tries_are_split_alike(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(20) | 0x1234 << 48 for _ in range(400)]
    fps = {b ^ (1 << rng.randrange(40)) for b in base} | set(base)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp bigint")

    def roots(sub_trie):
        return sorted(map(tuple, connected_components(linked_fingerprints(df, sub_trie=sub_trie)).collect()))

    assert roots(50) == roots(100_000)


def test_hook_reaches_smallest():
    root = np.arange(6)
    root = _hook(root, np.array([4, 3]), np.array([5, 4]))
    assert _hook(root, np.array([2]), np.array([5])).tolist() == [0, 1, 2, 2, 2, 2]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (9, 8), (9, 8)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_keep_one_keeps_all_columns_and_one_of_each(spark):
    rows = [(3, "a b c d e", "s", "x"), (1, "A b c d e", "s", "y"), (2, "q r s", "s", None), (2, "q r s", "s", None), (None, "zz", None, None)]
    kept = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "source", "component_id"]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "2", "None"]
    empty = spark.createDataFrame([], SCHEMA)
    assert keep_one(empty).count() == 0 and near_duplicates(empty).count() == 0


def test_fingerprint_of_ties_and_short_texts():
    assert fingerprint("") == 0 and fingerprint("One") == plain_fingerprint("one") != 0
