import random

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from llm_data import empty_documents, messy_documents, rows_of

from docflow.llm import pieces as P
from docflow.llm.tokencount import token_counts
from docflow.llm.transducer import Tokenizer

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "B", "1", "23", "!", "..", "é", "ß", "中", " ", "　", "<|endoftext|>", "<|", "|>", "😀", "the", " the", "ing", "'S"]


@pytest.fixture(scope="module")
def own():
    return Tokenizer(open(BPE, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(BPE)


def test_counts_equal_the_library(own, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 50))) for _ in range(3000)] + ["a" * 5000, " " * 3000, "=" * 999]
    assert [own.count_text(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_every_code_point_in_three_contexts(own, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for context in ("a{0}b ", " {0}{0}1", "\n{0} {0}"):
        texts = ["".join(context.format(c) for c in points[k : k + 3_000]) for k in range(0, len(points), 3_000)]
        assert [own.count_text(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_one_long_piece_with_few_states(own, library, monkeypatch):
    from docflow.llm import transducer

    monkeypatch.setattr(transducer, "MAX_STATES", 2_000)
    rng = random.Random(3)
    piece = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(120_000))
    assert own.count_text(piece) == len(library.encode(piece, add_special_tokens=False).ids)
    assert len(own.threads) <= 2_002
    assert own.count_text("x" + "ab" * 20_000) == len(library.encode("x" + "ab" * 20_000, add_special_tokens=False).ids)


def test_maps_of_chunks_within_one_piece_are_short(own, library):
    rng = random.Random(7)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000))
    numbers = "".join(rng.choice("0123456789") for _ in range(60_000))
    mixed = "".join(rng.choice("éñüaeßøλжш中") for _ in range(60_000))
    signs = "".join(rng.choice("=-_*#") for _ in range(60_000))
    for piece in (letters, "start of it " + letters[:50_000] + " and more " + numbers, mixed, signs, "a b " * 9_000 + letters[:40_000] + "'s end"):
        maps = [own.chunk_map(piece[k : k + 20_000]) for k in range(0, len(piece), 20_000)]
        assert max(len(m.head) + len(m.tail or "") for m in maps[:-1]) < 10_000
        assert own.total(list(maps)) == len(library.encode(piece, add_special_tokens=False).ids)
        left = maps[0]
        for m in maps[1:]:  # one by one
            left = own.compose(left, m)
        assert own.total([left]) == len(library.encode(piece, add_special_tokens=False).ids)


def test_certain_cuts_hold_whatever_precedes(own):
    rng = random.Random(9)
    cuts = 0
    for _ in range(60):
        alphabet = rng.choice(["abcdefghij", "etaoinshrdlu", "ab", "é中a", "=-", "0123456789"])
        text = "".join(rng.choice(alphabet) for _ in range(900)).encode()
        cut = own.certain_cut(text, 0, len(text))
        if cut is None:
            continue
        cuts += 1
        at, token, known = cut
        for _ in range(4):
            before = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))).encode()
            ids, ends, place = own.merged(before + text[: known + rng.randint(0, 100)]), [], 0
            for i in ids:
                place += len(own.text[i])
                ends.append(place)
            if len(before) + at in ends:
                assert ids[ends.index(len(before) + at)] == token
            else:
                raise AssertionError((text[:at], before))
    assert cuts > 40


def test_pieces_that_never_settle_and_cuts_at_any_place(own, library):
    rng = random.Random(2)
    for text in ("a" * 30_000, " " * 30_000 + "x", "ab" * 12_000 + "c", "ha" * 9_000 + " " * 9_000 + "\n" * 5_000, "x" * 9_000 + "'re" + "y" * 9_000 + "''s" * 3_000):
        want = len(library.encode(text, add_special_tokens=False).ids)
        for _ in range(3):
            places = sorted({0, len(text), *(rng.randint(0, len(text)) for _ in range(6))})
            assert own.total([own.chunk_map(text[a:b]) for a, b in zip(places, places[1:], strict=False)]) == want


def test_chunk_maps_compose_in_any_bracketing(own, library):
    rng = random.Random(2)
    for _ in range(120):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 1200)))
        size = rng.choice([40, 300, 500])
        maps = [own.chunk_map(text[i : i + size]) for i in range(0, len(text), size)] or [own.chunk_map("")]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert own.total(list(maps)) == n
        left = maps[0]
        for m in maps[1:]:
            left = own.compose(left, m)
        assert own.total([left]) == n


def test_token_counts_operator(spark, library):
    messy = messy_documents(spark)
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    expected = sorted(((r["doc_id"] is None, r["doc_id"] or 0), len((r["text"] or "").encode()), count(r["text"]), count(r["text"]) > 60) for r in messy.collect())
    for chunk in (1 << 16, 2_000):  # the long text as a few and as many chunks
        out = token_counts(messy, BPE, limit=60, chunk_chars=chunk)
        assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect()) == expected
    twice = messy.where("doc_id = 5").unionByName(messy.where("doc_id = 5"))
    assert len(set(rows_of(token_counts(twice, BPE, chunk_chars=2_000), "doc_id", "n_tokens"))) == 1
    assert token_counts(twice, BPE, chunk_chars=2_000).count() == 2
    assert token_counts(empty_documents(spark), BPE).count() == 0


def every_segmentation(model, pieces, s):
    out = []

    def go(i, ids, score):
        if i == len(s):
            out.append((score, tuple(ids)))
            return
        alone = False
        for j in range(i + 1, min(len(s), i + 16) + 1):
            entry = model["pieces"].get(s[i:j])
            if entry:
                alone = alone or j == i + 1
                go(j, [*ids, entry[0]], score + entry[1])
        if not alone:
            raw = s[i].encode()
            go(i + 1, [*ids, *(model["bytes"][b] for b in raw)], score + pieces.byte_score * len(raw))

    go(0, [], 0.0)
    return sorted(out, key=lambda x: -x[0])


def test_n_best_equals_all_segmentations_sorted():
    model = P.read_model(MODEL)
    pieces, rng, seen = P.Pieces(model), random.Random(3), 0
    while seen < 250:
        text = "".join(rng.choice(["the", "er", "a", " ", "  ", "\n", "é", "中", "龘", "in", "==", "="]) for _ in range(rng.randint(0, 6)))
        if len(text) > 12:
            continue
        seen += 1
        every = every_segmentation(model, pieces, P.MARK + text.replace(" ", P.MARK) if text else "")
        got = [(score, tuple(ids.tolist())) for score, ids in pieces.segment(text, 4)]
        assert [s for s, _ in got] == [s for s, _ in every[:4]]
        assert len(set(got)) == len(got) and set(got) <= set(every)
        assert all(pieces.decode(ids) == text for _, ids in got)


def test_decoding_equals_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = P.Pieces(P.read_model(MODEL))
    for text in ["Hello  world", "é\n中 龘 😀", " lead", "tab\tend "]:
        ids = sp.encode(text)
        assert pieces.decode(ids) == sp.decode(ids) == text


def test_encode_and_decode_operators(spark):
    messy = messy_documents(spark).drop("rank", "score").selectExpr("*", "'x' AS n_pieces")
    coded = P.encode(messy.withColumnRenamed("text", "body"), MODEL, n=2, text_col="body")
    back = P.decode(coded, MODEL).collect()
    texts = {}
    for r in messy.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"] or "")
    assert all(r["text"] in texts[r["doc_id"]] for r in back)
    assert {r["doc_id"] for r in back} == set(texts) and {r["rank"] for r in back} == {1, 2}
    assert [(r["rank"], r["n_pieces"], r["score"]) for r in back if r["doc_id"] == 3] == [(1, 0, 0.0)]
    assert sum(r["rank"] == 1 for r in back) == messy.count()
    assert P.encode(empty_documents(spark), MODEL).count() == 0


def test_links_side_by_side_equal_one_by_one():
    pieces = P.Pieces(P.read_model(MODEL))
    rng = random.Random(8)
    links = {"▁" * rng.randint(0, 2) + "".join(rng.choice("abthe ingé中😀#") for _ in range(rng.randint(1, 30))).replace(" ", "") for _ in range(900)}
    links = sorted(x for x in links | {"a", "▁", "\n", "😀", "x" * 400} if x)
    ids, place, size, scores, losses = pieces.best_of(links)
    for k, link in enumerate(links):
        raw, score, loss = pieces._best(link)
        assert ids[place[k] : place[k] + size[k]].tobytes() == raw and scores[k] == score and losses[k] == loss
    assert pieces.best_of([])[0].tolist() == []


def test_texts_together_equal_texts_alone_and_merge_ranks_are_not_the_library():
    pieces, sp = P.Pieces(P.read_model(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["international trade in the north", "", "a", "in the north\n\n  of  it", "international é中😀" * 30, "in the north\n\n  of  it", "y" * 3_000]
    together = list(pieces.segment_all(texts, 3))
    for text, ways in zip(texts, together, strict=True):
        alone = pieces.segment(text, 3)
        assert [(s, ids.tolist()) for s, ids in ways] == [(s, ids.tolist()) for s, ids in alone]
        assert all(pieces.decode(ids) == text for _, ids in ways)
    # the model's scores are merge ranks: their best sum isn't the library's greedy merging
    assert together[0][0][1].tolist() != sp.encode(texts[0])
