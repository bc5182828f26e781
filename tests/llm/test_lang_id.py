import numpy as np
from llm_edges import edge_docs, no_docs
from pyspark.sql import functions as F

from mirrorkit.llm import lang_id
from mirrorkit.llm.queries import op6_segmentation_langid


def all_segmentations(word, pieces, p):
    """Brute force: every way to cut the word; letters that are no piece stand alone."""
    def rest(at):
        if at == len(word):
            return 1.0
        total = 0.0
        for e in range(at + 1, min(len(word), at + lang_id.MAX_PIECE) + 1):
            if word[at:e] in pieces:
                total += p[pieces[word[at:e]]] * rest(e)
            elif e == at + 1:
                total += p[len(pieces) + 1] * rest(e)
        return total
    return rest(0)


def test_forward_sums_all_segmentations():
    pieces = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "▁ab": 5, "ba": 6}
    p = lang_id.normalised(np.random.default_rng(1).random(9))
    for words in (["abab", "baab", "azba"], ["a"], ["zz", "ab"]):
        got = lang_id.forward(lang_id.lattice(words, pieces), p)[:, -1]
        assert np.allclose(got, [all_segmentations("▁" + w, pieces, p) for w in words])
    # Expected counts add up to the derivative of the log-probability.
    lat = lang_id.lattice(["abab"], pieces)
    counts = lang_id.expected_counts(lat, p, np.ones(1))
    for k in range(7):
        more = p.copy()
        more[k] *= 1 + 1e-6
        d = np.log(lang_id.forward(lat, more)[0, -1] / lang_id.forward(lat, p)[0, -1]) / 1e-6
        assert np.isclose(counts[k], d, atol=1e-4)


def test_long_stretches_are_summed_whole():
    pieces = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "▁ab": 5, "ba": 6, "abab": 7}
    p = np.stack([lang_id.normalised(np.random.default_rng(k).random(10)) for k in (1, 2)], axis=1)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abz"), n)) for n in (1, 5, 33, 40, 64, 200, 3000)]
    with np.errstate(divide="ignore"):
        got = lang_id.long_log_words(words, pieces, np.log(p))
    for word, row in zip(words, got):
        for k in (0, 1):
            ways, scale = [1.0], 0.0  # prefix sums by hand, rescaled
            text = "▁" + word
            for e in range(1, len(text) + 1):
                total = 0.0
                for b in range(max(0, e - lang_id.MAX_PIECE), e):
                    q = p[pieces[text[b:e]], k] if text[b:e] in pieces else p[len(pieces) + 1, k] if e == b + 1 else 0.0
                    total += ways[b] * q
                ways.append(total)
                ways, scale = [w / total for w in ways], scale + np.log(total)
            assert np.isclose(row[k], scale, rtol=1e-9)
    for word in words[:4]:
        counts, log = lang_id.long_expected_counts(word, pieces, p[:, 0], 2.0)
        want, likely = lang_id.expectation(lang_id.lattice([word], pieces), p[:, 0], np.array([2.0]))
        assert np.allclose(counts, want) and np.isclose(2 * log, likely)
    # A word that crosses the former cut scores as a whole.
    model = lang_id.PieceModels("", ["x", "y"], p, np.zeros(2))
    lang_id._VOCABULARIES[""] = pieces
    scores = lang_id.WordScores(model)
    assert np.allclose(scores.sums([[words[3], "ab"], [], ["ab"]])[0], got[3] + scores.sums([["ab"]])[0])
    assert words[3] not in scores.rows and "ab" in scores.rows


def test_sentences_without_spaces(small_shuffles):
    from mirrorkit.llm.queries import tokenizer_path

    rng = np.random.default_rng(5)
    words = {"aa": ["information", "government", "people", "water"], "bb": ["wasser", "regierung", "leute", "straße"]}
    docs = small_shuffles.createDataFrame(
        [(i, "".join(rng.choice(words[lang], 30)), lang) for i in range(60) for lang in ("aa", "bb")], "doc_id bigint, text string, lang string")
    model = lang_id.fit(docs, tokenizer_path("piece_bpe_32k.model"), F.col("doc_id") < 40)
    rows = lang_id.predict(docs.filter("doc_id >= 40"), model).join(docs, "doc_id").collect()
    got = lang_id.predict(docs.filter("doc_id >= 40 AND lang = 'bb'"), model).collect()
    assert rows and {r.lang_pred for r in got} == {"bb"}


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = op6_segmentation_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("ok")).first()
    assert row.n > 100 and row.ok >= 0.97 * row.n


def test_edge_documents(small_shuffles):
    from mirrorkit.llm.queries import tokenizer_path

    docs = edge_docs(small_shuffles)
    model = lang_id.fit(docs, tokenizer_path("piece_bpe_32k.model"), F.lit(True))
    rows = lang_id.predict(docs, model).collect()
    assert len(rows) == docs.count()
    for r, d in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0)),
                    sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))):
        assert 0 <= r.score <= 1
        if d.doc_id is not None:
            letters = any(c.isalpha() for c in d.text or "")
            assert (r.lang_pred == "und") == (not letters)
    none = lang_id.fit(docs, tokenizer_path("piece_bpe_32k.model"), F.lit(False))
    assert none is None and {r.lang_pred for r in lang_id.predict(docs, none).collect()} == {"und"}
    assert lang_id.predict(no_docs(small_shuffles), model).count() == 0


def test_signs_without_letters_have_no_language(small_shuffles):
    from mirrorkit.llm.queries import tokenizer_path

    model = lang_id.fit(edge_docs(small_shuffles), tokenizer_path("piece_bpe_32k.model"), F.lit(True))
    docs = small_shuffles.createDataFrame([(1, "① ② ③ ½"), (2, "① ② ③ ④ ⑤ ½ ²"), (3, "① ② ③ ④ ⑤ wort")], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred == "und", r.score > 0) for r in lang_id.predict(docs, model).collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (False, True)}


def test_every_piece_of_letters_is_in_the_lattice():
    import re

    import sentencepiece

    from mirrorkit.llm.queries import tokenizer_path

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i)}
    letters = {p for p in pieces if p == p.lower() and re.fullmatch(r"▁?[^\W\d_]+", p)}
    known = lang_id.vocabulary(path)
    assert letters and letters <= set(known)
    lat = lang_id.lattice(["information"], known)
    assert lat[0, 0, len("▁information") - 1] == known["▁information"]
