"""Components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from tidewrack.llm import jaccard_join as J


def sets_of(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k=3, percent=90):
    sets = [sets_of(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for size in (3, 10, 11, 12, 13, 18, 19, 20, 21, 22, 25, 30, 40, 60, 90, 150):
        for _ in range(3):
            base = [rng.choice(vocabulary) for _ in range(size)]
            for _ in range(8):
                words = list(base)
                for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                    at = rng.randrange(len(words))
                    kind = rng.random()
                    if kind < 0.3:
                        words[at] = rng.choice(vocabulary).upper()
                    elif kind < 0.6:
                        words.append(rng.choice(vocabulary))
                    elif len(words) > 1:
                        words.pop(rng.choice([0, -1]))
                rows.append((doc, rng.choice([" ", "\n", " \t"]).join(words)))
                doc += 1
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    for _ in range(40):
        rows.append((doc, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 8)))))
        doc += 1
    rows += [(9000, None), (9001, ""), (9002, " \n "), (9003, "one"), (9004, "ONE"), (9005, "one two"), (9006, rows[5][1]), (9006, rows[5][1]), (None, rows[6][1]), (None, "lonely text here now")]
    return rows


@pytest.mark.parametrize("tile,rule", [(J.TILE, J.Rule()), (10, J.Rule(5, 80))])
def test_matches_brute_force(spark, monkeypatch, tile, rule):
    monkeypatch.setattr(J, "TILE", tile)
    rows = fixture(tile)
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, key int, n int").repartition(3)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df, rule).collect()]
    want = brute(rows, rule.shingle, rule.percent)
    assert sorted(got, key=repr) == want
    if rule == J.Rule(5, 80):
        kept = J.keep_one(df).collect()
        assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == sorted({(i, t) for i, t in rows for d, n, c in want if d == i and i is not None and (c == i or not n)})
        assert {r.key for r in kept} == {7}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(empty).collect() == [] and J.keep_one(empty).collect() == []


def test_linked_sets_share_a_list():
    """The list keys alone: every linked pair meets in a list."""
    rng = random.Random(3)
    for rule, n in [(r, n) for r in (J.Rule(), J.Rule(5, 80)) for n in [*range(4, 40), 77, 150]]:
        for _ in range(20):
            base = rng.sample(range(1, 10**9), n + 20)
            x = np.unique(np.array(base[:n], np.uint64))
            drop = rng.randint(0, n // 4)
            y = np.unique(np.array(base[drop // 2 : n + rng.randint(0, n // 18)], np.uint64))
            both = len(np.intersect1d(x, y))
            if len(x) != len(y) or both != len(x):
                if rule.links(both, len(x), len(y)):
                    assert set(J.list_keys(x, rule).tolist()) & set(J.list_keys(y, rule).tolist()), (n, len(y))


@pytest.mark.parametrize("rule", [J.Rule(), J.Rule(5, 80), J.Rule(5, 70)])
def test_list_entries_are_linear_in_the_set(rule):
    rng = np.random.default_rng(11)
    for n in (200, 500, 1000, 3000, 8677, 13000, 18000, 60000):
        x = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
        assert len(J.list_keys(x, rule)) <= 4 * n, n
    last = rule.classes[1:] - 1
    ahead = np.searchsorted(rule.classes, [rule.partner(int(n)) for n in last[: -rule.steps]], "right") - 1 - np.arange(len(last) - rule.steps)
    assert ahead.max() <= rule.steps and len(rule.classes) < J.LIGHT_LISTS


def test_linked_long_sets_share_a_list():
    """At the very limit of a link, for sizes at which few blocks can be passed over."""
    rng = np.random.default_rng(12)
    for rule in (J.Rule(), J.Rule(5, 80), J.Rule(5, 70)):
        for n in (60, 100, 137, 250, 400, 1000, 2011):
            for _ in range(20):
                all_ = np.unique(rng.integers(1, 2**63, 2 * n, dtype=np.uint64))
                rng.shuffle(all_)
                more = int(rng.integers(0, n * (100 - rule.percent) // 100))
                both = -(-rule.percent * (n + more) // 100)
                x, y = np.sort(all_[:n]), np.sort(np.concatenate([all_[n - both : n], all_[n : n + more]]))
                assert rule.links(len(np.intersect1d(x, y)), len(x), len(y))
                assert set(J.list_keys(x, rule).tolist()) & set(J.list_keys(y, rule).tolist()), (rule, n, more)


def test_components_equal_union_find(spark):
    from tidewrack.llm.components import connected_components, with_edges

    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(45)] + [(7, 7), (300, 301), (301, 300)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in connected_components(df).collect()}
    later = with_edges(connected_components(df.where("a % 3 = 0")), df.where("a % 3 <> 0"))
    assert got == want and {r.node: r.label for r in later.collect()} == want


def family(seed, members):
    """Copies of one text that share edits, so that many link with some others only."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    edits = [(rng.randrange(120), f"e{k}") for k in range(30)]
    rows = []
    for i in range(members):
        words = list(base)
        for at, word in rng.sample(edits, rng.randint(0, 9)):
            words[at] = word
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("group, members", [(J.GROUP, 90), (30, 40)])
def test_families_that_share_edits(spark, monkeypatch, group, members):
    """With few members a group, the larger family goes through lists of differences."""
    monkeypatch.setattr(J, "GROUP", group)
    monkeypatch.setattr(J, "TILE", 12)
    rows = family(1, members) + [(1000 + i, t.replace("b", "c")) for i, t in family(2, 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_settled_group_equals_union_find():
    rng = random.Random(6)
    for rule in (J.Rule(), J.Rule(5, 80)):
        for _ in range(20):
            pool = np.array(rng.sample(range(1, 10**9), 90), np.uint64)
            center = np.unique(pool[:70])
            sets = [np.unique(pool[rng.sample(range(90), rng.randint(55, 90))]) for _ in range(12)]
            labels = [rng.choice([1, 2, 3, 4, 5, 6]) for _ in sets]
            found = J.joining_links([(i, label, len(x), np.setxor1d(center, x)) for i, (label, x) in enumerate(zip(labels, sets, strict=True))], rule)
            comp = {}

            def root(x, comp=comp):
                while comp.setdefault(x, x) != x:
                    x = comp[x]
                return x

            links = [(i, j) for i in range(12) for j in range(i) if rule.links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))]
            for i, j in links:
                comp[root(labels[i])] = root(labels[j])
            want = [[root(labels[i]) == root(labels[j]) for j in range(12)] for i in range(12)]
            comp.clear()
            for i, j in found:
                assert (i, j) in links or (j, i) in links
                assert root(labels[i]) != root(labels[j])
                comp[root(labels[i])] = root(labels[j])
            assert want == [[root(labels[i]) == root(labels[j]) for j in range(12)] for i in range(12)]


def test_long_words_built_by_doubling_differ():
    """Words that a polynomial hash modulo 2^64 cannot tell apart."""
    from tidewrack.llm.common import word_hashes

    a, b = "a", "b"
    while len(a) < 4096:
        a, b = a + b, b + a
        assert len(np.unique(word_hashes(np.frombuffer(f"{a} {b}".encode(), np.uint8)))) == 2


def test_keep_one_with_clashing_names(spark):
    names = ["k_id", "k_th", "row", "m_id", "m_th", "__th", "stays", "rows", "th", "label", "g"]
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(i, t, *range(len(names))) for i, t in ((1, text), (2, text), (2, text), (None, text), (3, "other words"), (3, "other words"))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [(1, text, *range(len(names))), (3, "other words", *range(len(names)))]


def test_keys_of_many_sets_are_those_of_each():
    """Sets and lists made for many texts at once, short and odd ones among them."""
    rng = random.Random(4)
    many = [(t or "").encode() if t is not None else None for _, t in fixture(2)]
    many += [" ".join(rng.choice(["a", "b", f"c{rng.randrange(60)}"]) for _ in range(rng.randrange(90))).encode() for _ in range(300)]
    for rule in (J.Rule(), J.Rule(5, 80), J.Rule(5, 70)):
        x, begin = J.shingle_sets(many, rule.shingle)
        keys, of = J.keys_of_sets(x, begin, rule)
        for i, text in enumerate(many):
            alone = J.shingle_set(text, rule.shingle)
            assert np.array_equal(x[begin[i] : begin[i + 1]], alone)
            assert J.set_keys(x, begin)[i] == J.set_key(alone)
            assert sorted(keys[of == i].tolist()) == sorted(J.list_keys(alone, rule).tolist()), (rule, i)


def test_a_good_deal_enters_one_block_more_than_partners_can_change():
    rng = np.random.default_rng(14)
    for rule in (J.Rule(), J.Rule(5, 80)):
        for n in (500, 2000, 9000):
            own = int(np.searchsorted(rule.classes, n, "right")) - 1
            most = sum(rule.heavy(own - back)[0] + 1 for back in range(rule.steps + 1))
            assert len(J.list_keys(np.unique(rng.integers(1, 2**63, n, dtype=np.uint64)), rule)) <= most


def test_lists_of_the_same_sets_become_one():
    entries = [(key, sk, 30, sk) for key, sets in ((256, (1, 2)), (512, (2, 1)), (768, (1, 2, 3)), (1024, (4,)), (1280, (5, 5))) for sk in sets]
    key, sk, n, lists = J.several_sets(*(np.array(c, np.int64) for c in zip(*entries, strict=True)))
    found = sorted(sorted((int(s), int(c)) for s, c in zip(sk[key == k], lists[key == k], strict=True)) for k in np.unique(key))
    assert found == [[(1, 1), (2, 1), (3, 1)], [(1, 2), (2, 2)]] and set(n.tolist()) == {30}


def test_pairs_of_tiles_equal_the_whole_group():
    rng = random.Random(9)
    for rule in (J.Rule(), J.Rule(5, 80)):
        pool = np.array(rng.sample(range(1, 10**9), 90), np.uint64)
        center = np.unique(pool[:70])
        sets = [np.unique(pool[rng.sample(range(90), rng.randint(55, 90))]) for _ in range(40)]
        members = [(i, i, len(x), np.setxor1d(center, x)) for i, x in enumerate(sets)]
        tile = np.array([rng.randrange(3) for _ in members])

        def components(links):
            label = list(range(len(members)))
            for a, b in links:
                label = [label[a] if v == label[b] else v for v in label]
            return [[x == y for y in label] for x in label]

        parts = []
        for i in range(3):
            for j in range(i, 3):
                at = [k for k in range(len(members)) if tile[k] in (i, j)]
                parts += J.joining_links([members[k] for k in at], rule, tile[at])
        assert components(parts) == components(J.joining_links(members, rule))


def test_a_family_of_thousands_is_settled_in_one_round(spark, monkeypatch):
    """Different texts around one passage, most of them without a link."""
    rng = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for i in range(4100)]
    rows.append((5000, rows[7][1] + " more"))
    dealt_anew = []
    lists = J.difference_lists
    monkeypatch.setattr(J, "difference_lists", lambda pairs, *a: dealt_anew.append(pairs.count()) or lists(pairs, *a))
    got = {r.doc_id: r.component_id for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 7 if i == 5000 else i for i, _ in rows} and sum(dealt_anew) == 0


def test_batches_are_bounded_by_bytes(spark, monkeypatch):
    """Texts and packed lists are wide: the session's 64 MB a batch count twice in an executor."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, make = spark.conf.get(key), J.postings
    monkeypatch.setattr(J, "postings", lambda *a: seen.append(int(spark.conf.get(key))) or make(*a))
    df = spark.createDataFrame([(i, "some words of a text " * 5) for i in range(3)], "doc_id long, text string")
    assert {r.doc_id for r in J.keep_one(df).collect()} == {0}
    assert seen and max(seen) <= J.BATCH and spark.conf.get(key) == before
