"""Exact round trips: token-id files, media files, SentencePiece, token counts."""

import zlib
from hashlib import sha256

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from tidemark.llm import matroska, rangecoder  # noqa: E402
from tidemark.llm.pieces import Normalizer, Pieces, encode_digests, encode_spans  # noqa: E402
from tidemark.llm.token_counts import count_tokens  # noqa: E402
from tidemark.llm.tokens import ByteBpe  # noqa: E402

BPE, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b", "\n a", "▁", "a▁b", " ▁", "<s> </s>", "a <|endoftext|> b", "<|endoftext|>", "x \t y", "日本語 テスト 😀",
    "a\x00b", " x 　y", "é è", "don't I'll 'tis", "a \x1c b", "\x85 q", "one two", "one two", "word " * 9000 + "end", "x" * 5000, "12 345 6.7!? ((", "Ünïcödé ﬁ ½",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "src", 1) for k, t in enumerate(TEXTS)] + [(None, "no id", "src", 1), (3, TEXTS[3], "src", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n_tokens long")


def packed(ids):
    return np.asarray(ids, "<u4").tobytes()


def through(spark, blocks, vocab=50257):
    """(coded, decoded) of each block, in order."""
    df = spark.createDataFrame([(k, bytearray(packed(b))) for k, b in enumerate(blocks)], "k int, ids binary")
    coded = df.withColumn("block", rangecoder.encoded(spark, df["ids"], vocab)).repartition(4)
    rows = coded.withColumn("back", rangecoder.decoded(spark, coded["block"])).orderBy("k").collect()
    return [bytes(r["block"]) for r in rows], [np.frombuffer(r["back"], "<u4") for r in rows]


def test_blocks_round_trip(spark):
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 50257, n) for n in (1, 2, 777, 65536)] + [np.zeros(65536, int), np.arange(50000), np.full(300, 50256), np.tile([5, 9, 7], 500), rng.zipf(1.3, 20000) % 50257]
    coded, back = through(spark, blocks)
    for a, b in zip(blocks, back):
        assert (a == b).all()
    assert len(coded[4]) < 100 and len(coded[7]) < 100  # what repeats costs little
    assert through(spark, [blocks[2]])[0] == [coded[2]]  # a block doesn't depend on its neighbours
    for vocab in (1, 2, 64, 300, 1_000_000, 2**31 - 1):
        b = rng.integers(0, vocab, 1000)
        assert (through(spark, [b], vocab)[1][0] == b).all()


def test_the_mixture_beats_general_compression_and_single_shares(spark, sf_dir):
    bpe = ByteBpe.open(BPE)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    ids = np.array([k for t in texts for k in [*bpe.ids(t), 0]], "<u4")
    blocks = [ids[k : k + rangecoder.BLOCK] for k in range(0, len(ids), rangecoder.BLOCK)]
    size = sum(map(len, through(spark, blocks)[0]))
    share = np.bincount(ids)[ids] / len(ids)
    assert size < sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks)
    assert size < -np.log2(share).sum() / 8  # order-0 entropy of all ids, its table not counted


def test_damage_is_found(spark):
    (good,), _ = through(spark, [np.random.default_rng(1).integers(0, 50257, 500)])
    for bad in (b"XXXX" + good[4:], good[:40] + bytes([good[40] ^ 1]) + good[41:], good[:10], good[:4] + b"\xff" * 8 + good[12:]):
        df = spark.createDataFrame([(bytearray(bad),)], "block binary")
        with pytest.raises(Exception, match="block|vocabulary"):
            df.select(rangecoder.decoded(spark, df["block"])).collect()
    df = spark.createDataFrame([(bytearray(packed([7])),)], "ids binary")
    with pytest.raises(Exception, match="block|vocabulary"):  # outside the vocabulary
        df.select(rangecoder.encoded(spark, df["ids"], 7)).collect()


def test_token_files(spark, docs, tmp_path):
    path = f"file://{tmp_path}/ids"
    rangecoder.write_ids(docs, BPE, path, partitions=3)
    bpe = ByteBpe.open(BPE)
    got = rangecoder.read_ids(spark, path).orderBy("start").collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    at = 0
    for r, (_, text) in zip(got, rows):
        ids = bpe.library.encode(text, add_special_tokens=False).ids + [0]
        assert r["start"] == at and r["ids"] == ids
        at += len(ids)
    crc = {r["start"]: r["ids_crc32"] for r in rangecoder.read_digests(spark, path).collect()}
    assert all(crc[r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    assert docs.limit(0).count() == 0
    long_ = spark.createDataFrame([(1, "a b " * 50_000), (2, "x"), (3, "c d " * 40_000)], "doc_id long, text string")
    rangecoder.write_ids(long_, BPE, path + "1", partitions=1)
    assert [len(r["ids"]) for r in rangecoder.read_ids(spark, path + "1").orderBy("start").collect()] == [len(bpe.ids(t)) + 1 for t in ("a b " * 50_000, "x", "c d " * 40_000)]
    rangecoder.write_ids(docs.limit(0), BPE, path + "0")
    assert rangecoder.read_digests(spark, path + "0").count() == 0


def test_media_round_trip(docs):
    files = matroska.to_media(docs)
    made = {(r["doc_id"], r["payload_sha256"]): r for r in matroska.media_digests(files).collect()}
    for r in docs.collect():
        n, payload = matroska.padded(r["text"] or "")
        got = made[r["doc_id"], sha256(payload).hexdigest()]
        assert (got["n_bytes"], got["payload_bytes"], got["tail_crc32"]) == (n, len(payload), zlib.crc32(payload[-16:]))
        media = matroska.mux(payload)
        assert (got["media_bytes"], got["media_sha256"]) == (len(media), sha256(media).hexdigest())
    packets = matroska.packet_table(files.where("doc_id = 27")).orderBy("packet").collect()
    text = matroska.padded(TEXTS[27])[1]
    media = matroska.mux(text)
    assert b"".join(media[p["byte_start"] : p["byte_start"] + p["n_bytes"]] for p in packets) == text
    assert [p["timestamp_ns"] for p in packets] == [24_000_000 * k for k in range(len(packets))]


def test_other_lacings_groups_and_unknown_sizes():
    m = matroska
    frames = [b"a" * 300, b"b" * 10, b"c" * 700, b"d" * 5]
    xiph = bytes([3, 255, 45, 10, 255, 255, 190])
    ebml = bytes([3]) + (300 | 0x4000).to_bytes(2, "big") + (-290 + 0x1FFF | 0x4000).to_bytes(2, "big") + (690 + 0x1FFF | 0x4000).to_bytes(2, "big")
    blocks = m.element(m.SIMPLE_BLOCK, b"\x81\x00\x05\x82" + xiph + b"".join(frames)) + m.element(m.BLOCK_GROUP, m.element(m.BLOCK, b"\x82\xff\xff\x06" + ebml + b"".join(frames)))
    unknown = lambda kind, body: kind.to_bytes(4, "big") + b"\x01\xff\xff\xff\xff\xff\xff\xff" + body
    data = m.HEADER + unknown(m.SEGMENT, m.TRACK + unknown(m.CLUSTER, m.number(m.TIMESTAMP, 1000) + blocks) + unknown(m.CLUSTER, m.number(m.TIMESTAMP, 2000) + m.element(m.SIMPLE_BLOCK, b"\x81\x00\x00\x00" + b"z")))
    p = m.Parser(data).parse()
    assert [data[a : a + n] for a, n in p.packets[:, 2:4]] == frames * 2 + [b"z"]
    assert list(p.packets[:, 1]) == [1] * 4 + [2] * 4 + [1] and list(p.packets[:, 5]) == [0] * 8 + [1]
    assert p.packets[0, 0] == 1_005_000_000 and p.packets[4, 0] == 999_000_000 and p.packets[8, 0] == 2_000_000_000
    with pytest.raises(ValueError):
        m.Parser(m.mux(b" " * 192)[:-30]).parse()


def test_sentencepiece_equals_the_library(docs):
    p = Pieces.open(MODEL)
    got = {(r["doc_id"], r["ids_sha256"]): r for r in encode_digests(docs, MODEL).collect()}
    for r in docs.collect():
        ids = [p.library.bos_id(), *p.library.encode(r["text"] or ""), p.library.eos_id()]
        row = got[r["doc_id"], sha256(np.array(ids, "<u4").tobytes()).hexdigest()]
        assert row["n_tokens"] == len(ids) and row["decoded_sha256"] == sha256(p.library.decode(ids).encode()).hexdigest()


def test_spans_cover_the_source(docs):
    for r in encode_spans(docs, MODEL).where("doc_id <> 27").collect():
        text = (TEXTS[r["doc_id"]] or "").encode()
        assert r["starts"][0] == 0 and r["ends"][-1] == len(text)
        assert r["starts"][1:] == r["ends"][:-1]
        p = Pieces.open(MODEL).library
        for k, (a, b) in enumerate(zip(r["starts"][1:-1], r["ends"][1:-1]), 1):
            piece = p.id_to_piece(r["ids"][k])
            if not piece.startswith("<0x"):
                assert piece.replace("▁", " ").strip(" ") == text[a:b].decode().replace("▁", " ").strip(" ")


def test_normalizer_with_a_character_map():
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    n = Normalizer(model.normalizer_spec)
    for text in ("ＡＢＣ ﬁ  x", "  a  b ", "㌔ half ½ カﾞ", "plain", "", "  ", "é́ ２", "日本 語"):
        out, align = n(text)
        want, offsets = library.normalize(text, with_offsets=True)
        assert out.decode() == want
        starts = [len(text[:o].encode()) for o in offsets]
        at = np.cumsum([0] + [len(c.encode()) for c in want])
        assert [int(align[k]) for k in at] == starts[: len(at)]


@pytest.mark.parametrize("path", [BPE, MODEL])
def test_token_counts_equal_the_library(docs, path):
    library = ByteBpe.open(BPE).library if path == BPE else Pieces.open(MODEL).library
    count = (lambda t: len(library.encode(t, add_special_tokens=False).ids)) if path == BPE else (lambda t: len(library.encode(t)))
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(docs, path).collect())
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), count(r["text"] or ""), count(r["text"] or "") > 1024) for r in docs.collect())
    assert got == want


def test_latin_ids_equal_the_library(spark, sf_dir):
    rng = np.random.default_rng(5)
    alphabet = list("abcdefghijklmnopqrstuvwxyz" * 3 + "  \n\t\r''.,;!?-()[]<|>0123456789ABCéèüßñøŁžɏ²½×÷ªº§") + ["'s", "'re", "'ll", " 've", "  ", "\n\n", "don't", " the", "<|endoftext|>", " ", "日", "\x0b", "\x85"]
    weights = np.array([1.0] * (len(alphabet) - 4) + [0.02] * 4)
    texts = ["".join(rng.choice(alphabet, n, p=weights / weights.sum())) for n in rng.integers(0, 120, 1500)]
    texts += ["x" * 5000, "ab" * 3000, "".join(rng.choice(list("abcde"), 3000)), "=" * 700, " " * 400, "\n" * 300 + "a"]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [t for t in TEXTS if t]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    bpe, n = ByteBpe.open(BPE), 0
    for r in df.select("k", "text", rangecoder.latin_ids(spark, df["text"], BPE).alias("ids")).collect():
        if r["ids"] is not None:
            assert np.frombuffer(r["ids"], "<u4").tolist() == bpe.ids(r["text"]), r["text"]
            n += 1
        else:
            assert any(c > "ɏ" or c in "\x0b\x85\x00\x1c\xa0" for c in r["text"]) or "<|endoftext|>" in r["text"]
    assert n > 1000


def test_cues_of_several_tracks_and_damaged_files(spark):
    m = matroska
    position = lambda track, at: m.element(m.CUE_TRACK_POSITIONS, m.number(m.CUE_TRACK, track) + m.number(m.CUE_CLUSTER_POSITION, at))
    cues = m.element(m.CUES, m.element(m.CUE_POINT, m.number(m.CUE_TIME, 7) + position(1, 100) + position(2, 200)) + m.element(m.CUE_POINT, m.number(m.CUE_TIME, 9) + position(1, 300)))
    data = m.HEADER + m.element(m.SEGMENT, m.TRACK + cues)
    found = m.Parser(data).parse()
    base = len(data) - len(m.TRACK) - len(cues)
    assert [tuple(c) for c in found.cues] == [(7_000_000, 1, 100 + base), (7_000_000, 2, 200 + base), (9_000_000, 1, 300 + base)]
    short = m.element(m.CLUSTER, m.element(m.SIMPLE_BLOCK, b"\x81"))
    odd = m.element(m.TRACKS, m.element(m.TRACK_ENTRY, m.element(m.AUDIO, m.element(m.SAMPLING_FREQUENCY, b"abc"))))
    laced = m.element(m.CLUSTER, m.element(m.SIMPLE_BLOCK, b"\x81\x00\x00\x02\x05"))
    deep = b""
    for _ in range(3000):
        deep = m.element(m.BLOCK_GROUP, deep)
    files = [m.HEADER + m.element(m.SEGMENT, x) for x in (short, odd, laced, deep)] + [b"", None, b"\x00" * 9, m.mux(b" " * 192)]
    for f in files[:4]:
        with pytest.raises(ValueError):
            m.Parser(f).parse()
    table = m.packet_table(spark.createDataFrame([(k, None if f is None else bytearray(f)) for k, f in enumerate(files)], "doc_id int, media binary"))
    assert {r["doc_id"] for r in table.collect()} == {len(files) - 1}
