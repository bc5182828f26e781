import random
from collections import Counter

from llm_edges import edge_docs, no_docs

from mirrorkit.llm import jaccard_join


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(docs):
    sets = {}
    for i, t in docs:
        sets.setdefault(i, shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(i for i in sets if i is not None)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return Counter((i, len(shingles(t)), find(i) if i is not None else None) for i, t in docs)


def got(df):
    return Counter(tuple(r) for r in jaccard_join.jaccard_components(df).collect())


def planted(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 200))
    docs = []
    for group in range(25):
        base = [word() for _ in range(rng.choice([3, 5, 6, 8, 9, 10, 12, 13, 14, 15, 17, 18, 19, 20, 25, 40, 90, 200]))]
        for copy in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(at, word()), lambda: w.insert(at, word()), lambda: len(w) > 1 and w.pop(at)])()
            if rng.random() < 0.2:
                w = w + [word() for _ in range(rng.randint(1, 3))]
            docs.append((1000 * group + copy + 1, " ".join(w).title() if copy % 2 else "\n".join(w)))
    passage = [word() for _ in range(60)]
    docs += [(90_000 + i, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])) for i in range(40)]
    rng.shuffle(docs)
    return docs


def test_brute_force(small_shuffles, monkeypatch):
    docs = planted(1)
    df = small_shuffles.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert got(df) == brute(docs)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(jaccard_join, "HEAVY", 5)
    for boundaries in ((0,), (14,)):
        monkeypatch.setattr(jaccard_join, "BOUNDARIES", boundaries)
        assert got(df) == brute(docs)


def test_edge_documents(small_shuffles):
    df = edge_docs(small_shuffles)
    assert got(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert jaccard_join.jaccard_components(no_docs(small_shuffles)).count() == 0


def test_boundary_follows_cost():
    assert jaccard_join.choose_boundary({12: 10, 9: 10}) < 14
    assert jaccard_join.choose_boundary({3: 1000, 4: 1000}) >= 4
