import hashlib
import random
from collections import Counter

import numpy as np
from llm_edges import edge_docs, no_docs

from mirrorkit.llm import lpf_dedup


def brute(docs, length, keep):
    """{place: (n_bytes, n_removed, n_spans, sha256)} in order of (id, text)."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    starts = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is not None, texts[k][0] or 0, hashlib.md5(texts[k][1]).digest()))
    first, out = {}, {}
    for k in order:
        for s in range(len(texts[k][1]) - length + 1):
            first.setdefault(texts[k][1][s : s + length], (texts[k], s))
    for k, (doc_id, b) in enumerate(texts):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if starts[w] > 1 and (keep == "none" or first[w] != ((doc_id, b), s)):
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[k] = (doc_id, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def planted(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, long_one = text(70), text(120)
    docs = [(i, text(rng.randint(0, 150))) for i in range(25)]
    docs += [(50 + i, text(20) + passage + text(25)) for i in range(6)]
    base = text(200)
    for i in range(8):
        at = rng.randint(0, len(base) - 1)
        docs.append((70 + i, base[:at] + "#" + base[at + 1 :]))
    docs += [(90, base), (91, base), (92, long_one + long_one), (93, "ab" * 300), (94, "a" * 450), (95, "a" * 199), (96, "a" * 200)]
    return docs


def quadratic_lpf(pieces):
    """Per position of the pieces laid end to end: the longest string that starts there and earlier; none crosses an end."""
    suffixes = [p[i:] for p in pieces for i in range(len(p))]

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    return suffixes, [max((shared(s, t) for t in suffixes[:i]), default=0) for i, s in enumerate(suffixes)]


def test_longest_previous_factors_against_quadratic_ones():
    rng = random.Random(4)
    cases = [[b"abracadabra"], [b"a" * 40], [b"ab" * 30], [b"\0" * 20, b"\0" * 9, b"", b"x\0\0"], [b""], [b"q"]]
    cases += [[bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 6))]
              for alphabet in (b"ab", b"abc\0", b"abcdefgh") for _ in range(25)]
    cases.append([bytes(rng.choice(b"ab") for _ in range(300)) * 3, b"ab" * 200])
    for pieces in cases:
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        left = np.concatenate([np.arange(len(p), 0, -1) for p in pieces]).astype(np.int64)
        suffixes, want = quadratic_lpf(pieces)
        ranks = lpf_dedup.suffix_ranks(data, left)
        order = np.argsort(ranks[-1], kind="stable")
        assert [suffixes[i] for i in order] == sorted(suffixes)
        common = np.zeros(len(order), dtype=np.int64)
        common[1:] = lpf_dedup.common_prefixes(ranks, data, left, order[:-1], order[1:])
        got = [0] * len(order)
        for place, value in zip(order, lpf_dedup.longest_previous(order.tolist(), common.tolist())):
            got[place] = value
        assert got == want
        # Decided windows follow from the factors.
        for length in (1, 3, 20):
            which, place, decided = lpf_dedup.repeated_suffixes(pieces, length, "first") if len(data) else ([], [], [])
            start = np.cumsum([0] + [len(p) for p in pieces])
            assert [start[w] + p for w, p, d in zip(which, place, decided) if d] == [i for i in range(len(want)) if want[i] >= length]


def test_brute_force_both_ways(small_shuffles, monkeypatch):
    docs = planted()
    df = small_shuffles.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for keep in ("none", "first"):
        assert got(lpf_dedup.dedup_passages(df, keep)) == brute(docs, 200, keep)
    # Large groups take the other way, and large sides shuffle; the outcome is the same.
    monkeypatch.setattr(lpf_dedup, "MAX_GROUP", 2)
    monkeypatch.setattr(lpf_dedup, "BROADCAST_ROWS", 0)
    for keep in ("none", "first"):
        assert got(lpf_dedup.dedup_passages(df, keep)) == brute(docs, 200, keep)


def test_edge_documents(small_shuffles):
    df = edge_docs(small_shuffles)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert got(lpf_dedup.dedup_passages(df)) == brute(docs, 200, "none")
    assert lpf_dedup.dedup_passages(no_docs(small_shuffles)).count() == 0


def test_repeated_rows_beside_an_edited_copy(small_shuffles, monkeypatch):
    rng = random.Random(5)
    base = " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(120))
    docs = [(1, base), (1, base), (1, base), (2, base[:350] + "#" + base[351:]), (None, base[:500]), (None, base[:500])]
    df = small_shuffles.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for group in (lpf_dedup.MAX_GROUP, 1):
        monkeypatch.setattr(lpf_dedup, "MAX_GROUP", group)
        for keep in ("none", "first"):
            assert got(lpf_dedup.dedup_passages(df, keep)) == brute(docs, 200, keep)


def test_long_texts_are_cut_into_segments(monkeypatch):
    rng = random.Random(1)
    text = bytes(rng.choice(b"abc") for _ in range(5000))
    monkeypatch.setattr(lpf_dedup, "_SEGMENT", 700)
    windows = set()
    for parts, data, ends in lpf_dedup._segments([text, b"short", text[100:900]], 200):
        start, n, _, _ = lpf_dedup.runs_of(data, ends)
        part = np.searchsorted(ends, start, side="right")
        for s, w, p in zip(start, n, part):
            begin = s - (ends[p - 1] if p else 0) + parts[p][1]
            windows |= {(parts[p][0], int(b)) for b in range(begin, begin + w)}
    assert windows == {(0, s) for s in range(4801)} | {(2, s) for s in range(601)}


def test_cuts_at_whole_characters():
    text = ("é" * 150).encode()
    kept, spans = lpf_dedup.remove_ranges(text, [(1, 1)], 200, characters=True)
    assert kept.decode() == "é" * 49 and spans == 1
