import itertools
import random

from pyspark.sql import functions as F

from prepwise.llm import pieces
from prepwise.llm.pieces import MARK, Encoder, Vocabulary

TEXTS = ["Hello world", " a  b\n c\t", "", "é̀ ﬁ Ａ x\r\n", "no_break\u00a0here 漢字 😀", "x" * 5000, "   ", "\n", "The quick brown fox jumps over 12345 lazy dogs."]


def small():
    names = ["<unk>", "a", "b", "ab", "ba", "aab", MARK, MARK + "a", MARK + "ab", MARK * 2] + [f"<0x{b:02X}>" for b in range(256)]
    rng = random.Random(4)
    return Vocabulary(names, [round(-rng.random() * 10, 3) for _ in names], list(range(10, 266)), {0})


def all_paths(v, text, at=0):
    if at == len(text):
        return [(0.0, ())]
    out = []
    for end in range(at + 1, len(text) + 1):
        for s, score, ids in v.edges(text, end):
            if s == at:
                out += [(score + x, ids + y) for x, y in all_paths(v, text, end)]
    return out


def test_unit_nbest_matches_enumeration():
    v = small()
    for n in range(1, 7):
        for chars in itertools.product("ab?", repeat=n):
            unit = MARK + "".join(chars)
            want = sorted((x for x, _ in all_paths(v, unit)), reverse=True)[:4]
            got = v.nbest(unit, 4)
            assert all(abs(a[0] - b) < 1e-9 for a, b in zip(got, want)) and len(got) == len(want)
            assert len({ids for _, ids in got}) == len(got)


def test_text_nbest_matches_enumeration():
    v = small()
    for text in ("ab ba", "aab  ab b", "a a a", "b?a ab", " ", "  ab"):
        lattice = MARK + text.replace(" ", MARK)
        every = sorted(((x, ids) for x, ids in all_paths(v, lattice)), reverse=True)
        for best in (1, 2, 5):
            ids, score, further = Encoder(v, best).encode(text)
            got = [(score, tuple(ids.tolist()))] + [(f["score"], tuple(pieces.apply_changes(ids, f["changes"]))) for f in further]
            assert len(got) == min(best, len(every)) and len({g[1] for g in got}) == len(got)
            for (a, path), (b, _) in zip(got, every):
                assert abs(a - b) < 1e-9
                assert any(path == p and abs(a - s) < 1e-9 for s, p in every)


def test_round_trip_and_library_decoder():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    v = Vocabulary.load()
    e = Encoder(v)
    for t in TEXTS:
        ids, score, further = e.encode(t)
        assert v.decode(ids.tolist()) == t == sp.decode(ids.tolist())
        if t:
            assert len(further) == 2 or len(t) < 2
            assert score >= sum(s for s in (e.vocabulary.ids.get(sp.id_to_piece(i), (0, v.unknown))[1] for i in sp.encode(t) if not sp.is_byte(i))) + v.unknown * len(t)
        for f in further:
            other = pieces.apply_changes(ids, f["changes"])
            assert v.decode(other) == t and len(other) == f["n_pieces"] and f["score"] <= score


def test_documents(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, "twice"), (3, "twice"), (50, "a" + MARK + "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("score", F.lit(0))
    out = pieces.encode_documents(df.repartition(3))
    got = {(r["doc_id"], r["n_pieces"]): r for r in out.collect()}
    assert out.count() == len(rows)
    e = Encoder(Vocabulary.load())
    for i, t in rows:
        ids, score, further = e.encode(t)
        r = got[(i, len(ids))]
        assert r["ids"] == ids.tolist() and abs(r["score"] - score) < 1e-6 and len(r["nbest"]) == len(further)
        assert r["round_trip"] == (i != 50)
    back = {(r["doc_id"], r["text"]) for r in pieces.decode_documents(out.drop("text")).collect()}
    assert back == {(i, (t or "").replace(MARK, " ")) for i, t in rows}
    assert pieces.encode_documents(df.limit(0)).count() == 0


def test_cache_limit_does_not_change_results(monkeypatch):
    v = Vocabulary.load()
    texts = [f"word{i} and word{i + 1}" for i in range(50)]
    want = [Encoder(v).encode(t)[0].tolist() for t in texts]
    monkeypatch.setattr(pieces, "_CACHE_UNITS", 5)
    e = Encoder(v)
    assert [e.encode(t)[0].tolist() for t in texts] == want
