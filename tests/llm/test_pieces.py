import random

import pytest

from starloom.llm import piece_lattice as lattice
from starloom.llm import prefix_tokens as tokens
from starloom.llm.queries import piece_table

sentencepiece = pytest.importorskip("sentencepiece")
SCHEMA = "doc_id long, text string, word string, ids string"


@pytest.fixture(scope="module")
def processor():
    import public_tokenizers

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    table = piece_table()
    odd = ["", " ", "  a  b", "\n\n", "<s> </s> <0x0A>", "漢字🙂é", "▁▁x", "a" * 300, "=" * 77, "x\u0000y", "word.\nNext, line\tand tab", "ß" * 70 + " end"]
    return odd + ["".join(rnd.choice(table.pieces) if rnd.random() < 0.5 else rnd.choice("abc thiserano.,\n\t éß漢🙂") for _ in range(rnd.randint(1, 25))) for _ in range(150)]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(10_000, None, "x", "y")], SCHEMA).repartition(3)


def test_counts_and_cuts_match_the_library(spark, processor, texts):
    got = {r.doc_id: r for r in tokens.token_counts(rows(spark, texts), piece_table(), limit=9).collect()}
    for i, t in enumerate(texts):
        n = len(processor.encode(t))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 9)
        assert got[i].keep_chars == max(k for k in range(len(t) + 1) if len(processor.encode(t[:k])) <= 9)
    assert (got[10_000].n_tokens, got[10_000].n_bytes) == (0, 0)


def test_every_prefix_matches_the_library(spark, processor, texts):
    short = [t for t in texts if len(t) < 60]
    stored = tokens.prefix_counts(rows(spark, short), piece_table())
    for r in stored.collect():
        t = short[r.doc_id] if r.doc_id < len(short) else ""
        assert r.counts == [len(processor.encode(t[:k])) for k in range(len(t) + 1)]
    for r in tokens.within_budget(stored, 4).collect():
        t = short[r.doc_id] if r.doc_id < len(short) else ""
        assert r.chars == max(k for k in range(len(t) + 1) if len(processor.encode(t[:k])) <= 4)


def test_lattice_encodes_like_the_library_and_back(spark, processor, texts):
    table = piece_table()
    encoded = lattice.encode_documents(rows(spark, texts), table).cache()
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {i: processor.encode(t) for i, t in enumerate(texts)} | {10_000: []}
    back = {r.doc_id: r.text for r in lattice.decode_documents(encoded, table).collect()}
    assert back == {i: t.replace("▁", " ") for i, t in enumerate(texts)} | {10_000: ""}


def test_digests_sum_the_ids(spark, processor, texts, monkeypatch):
    monkeypatch.setattr(lattice, "FREQUENT", 20)
    twice = rows(spark, texts).unionByName(rows(spark, texts[:40]))
    got = sorted((r.doc_id, r.n_pieces, r.id_sum, r.round_trip) for r in lattice.document_digests(twice, piece_table()).collect())
    ids = [(i, processor.encode(t)) for i, t in enumerate(texts)]
    want = [(i, len(x), sum(x), True) for i, x in ids + ids[:40]] + [(10_000, 0, 0, True)] * 2
    assert got == sorted(want)
    assert lattice.document_digests(spark.createDataFrame([], SCHEMA), piece_table()).count() == 0


def test_viterbi_fold_matches_the_library_on_a_unigram_table(spark, texts):
    import public_tokenizers
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    other = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    table = piece_table(kind="unigram")
    some = [t for t in texts if not any(c in t for c in "\u0000")]
    score = {i: s for i, s in zip(table.ids, table.scores, strict=True)}
    for r in lattice.encode_documents(rows(spark, some), table).collect():
        want = other.encode(some[r.doc_id]) if r.doc_id < len(some) else []
        assert sum(score.get(i, 0) for i in r.ids) == pytest.approx(sum(score.get(i, 0) for i in want)) and (len(r.ids) == len(want) or r.ids != want)


def test_digests_see_wrong_ids_their_order_and_marks_in_the_text(spark, monkeypatch):
    from dataclasses import replace

    table = piece_table()
    texts = ["one two three two", "two one three two", "two three two one", "a▁b", "漢 one", "x" * 60 + " one", "q" * 60 + "𓀀"]

    def digests(t):
        return {r.doc_id: r for r in lattice.document_digests(rows(spark, texts), t).collect()}

    for frequent in (40_000, 2):
        monkeypatch.setattr(lattice, "FREQUENT", frequent)
        got = digests(table)
        assert [got[i].round_trip for i in range(7)] == [True] * 7
        assert [got[i].exact for i in range(7)] == [True, True, True, False, True, True, True]
        assert len({got[i].id_hash for i in range(3)}) == 3 and len({got[i].id_sum for i in range(3)}) == 1
        want = got if frequent > 2 else want
        assert {i: r.id_hash for i, r in got.items()} == {i: r.id_hash for i, r in want.items()}
        # without byte pieces an unknown character is one id that spells nothing
        assert not digests(replace(table, byte_ids=(-1,) * 256))[6].round_trip
        # two ids that change places as the lattice is made, but not where ids are decoded
        right = lattice.pieces_frame
        a, b = (table.ids[table.pieces.index(p)] for p in ("▁one", "▁two"))
        with monkeypatch.context() as m:
            m.setattr(lattice, "pieces_frame", lambda s, t: right(s, replace(t, ids=tuple({a: b, b: a}.get(i, i) for i in t.ids))))
            got = digests(table)
        assert [got[i].round_trip for i in range(7)] == [False, False, False, True, False, False, True]


def test_long_words_go_through_the_lattice_in_parts(spark, processor, monkeypatch):
    from dataclasses import replace

    rnd = random.Random(12)
    table = piece_table()
    letters = [p for p in table.pieces if p.isalpha() and p.isascii()]
    glued = ["".join(rnd.choice(letters) for _ in range(n)) for n in (12, 14, 40, 200)]
    texts = [*glued, "a" * 997, "ab" * 48, "é漢🙂" * 40, "q" * 48 + "𓀀" * 3 + "z" * 96, f"so {glued[2]} {glued[3]} on", glued[2][:96] + "\n" + glued[3][:95]]

    def ids(t, kind="bpe"):
        return {r.doc_id: r.ids for r in lattice.encode_documents(rows(spark, texts), t if kind == "bpe" else replace(t, kind=kind)).collect()}

    want = {i: processor.encode(t) for i, t in enumerate(texts)} | {10_000: []}
    assert ids(table) == want
    best = ids(table, "unigram")
    with monkeypatch.context() as m:  # nearly all words in parts
        m.setattr(lattice, "MAX_WORD", 3)
        assert ids(table) == want and ids(table, "unigram") == best
    # a piece's id that the lattice has, but not the table of what ids decode to, shows in a long word
    common = max(set(want[4]), key=want[4].count)
    right = lattice.pieces_frame
    monkeypatch.setattr(lattice, "pieces_frame", lambda s, t: right(s, replace(t, ids=tuple(table.ids[0] if i == common else i for i in t.ids))))
    got = {r.doc_id: r.round_trip for r in lattice.document_digests(rows(spark, texts), table).collect()}
    assert not got[4] and got[7]
