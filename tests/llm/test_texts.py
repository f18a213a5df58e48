"""Row-wise operators: personal data, media, byte-pair encoding, toxicity."""

import base64
import hashlib
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.llm import bpe, media, pii, toxicity

from ..conftest import SMALL
from .helpers import frame


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        total = sum(sum(divmod(2 * c, 10)) if i % 2 else c for i, c in enumerate(digits))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    parts = ["@", "a.b", "b", "-", ".", "1", "2", "4", "255", "256", " ", "+", "(", ")", "1.2", "é", "a@b.c", "4242 4242 4242 4242", "+1 (555) 010-9999", "_%"]
    for _ in range(6000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert pii.detect(t) == base_spans(t), t


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("write john [at] mail [dot] example.com now", "email:6:38"),
        ("john at mail dot example dot com", "email:0:32"),
        ("call plus one five five five one two three four five six seven now", "phone:5:62"),
        ("іvan@exаmple.com", "email:0:16"),
        ("192[.]168(dot)0[.]1", "ip:0:19"),
        ("ping １９２.１６８.０.１ now", "ip:5:16"),
        ("meet at noon dot. look at the re. Foo and one two of them", ""),
        ("a@b.c and 10.0.0.1", "email:0:5,ip:10:18"),
    ],
)
def test_disguises(text, found):
    base, spans = pii.find(text)
    assert ",".join(f"{k}:{s}:{e}" for k, s, e in spans) == found
    assert set(base) <= set(spans)


@pytest.mark.parametrize(
    ("text", "masked"),
    [
        ("one nine two dot one six eight dot zero dot one", "<ip>"),
        ("at 192.one six eight.0.1 now", "at <ip> now"),
        ("+1 (five five five) 010-9999", "<phone>"),
        ("card 4242 four two 42 4242 4242 ok", "card <card> ok"),
        ("john [AT] example [DOT] com", "<email>"),
        ("john (At) example.com", "<email>"),
        ("one of five took version two to 10.0.0.1", "one of five took version two to <ip>"),
        ("call +1 555 123 4567 one day", "call <phone> one day"),
    ],
)
def test_short_spelled_runs_and_capital_marks(text, masked):
    assert pii.mask(text) == masked


@pytest.mark.parametrize("text", ["jоhn.smith@example.com", "jane [dot] doe@example.com", "a@mail.example [dot] com"])
def test_spans_outgrow_their_stumps(text):
    base, spans = pii.find(f"to {text} now")
    assert len(base) == 1 and set(base) < set(spans) and ("email", 3, 3 + len(text)) in spans
    assert pii.mask(f"to {text} now") == "to <email> now"


def test_long_texts_take_linear_time():
    for t in ("a" * 200_000 + "@", "1." * 100_000, "1" * 200_000, "+1" * 100_000, "[at]" * 50_000, "one " * 50_000, "a@" * 50_000, "zero " * 40_000 + ".1.1.1", "\u0660" * 30_000, "+(" * 50_000, "1-" * 60_000, "dot " * 40_000):
        pii.find(t)
    # More digits than Python turns into one number at once.
    for zeros in (1, 4_299, 5_000, 200_000):
        assert pii.detect("0" * zeros + ".1.1.1") == [("ip", 0, zeros + 6)] and pii.detect("1" + "0" * zeros * 3 + ".1.1.1") == []
        assert pii.mask("x " + "0" * zeros + ".1.1.1") == "x <ip>"
    assert pii.find("\uff10" * 5_000 + ".1.1.1")[1] == [("ip", 0, 5_006)]


def test_spans_frame(spark):
    rows = [(1, "a@b.co x"), (1, "a@b.co x"), (2, None), (3, ""), (None, "10.0.0.1"), (4, "Ü +49 (30) 123-4567")]
    got = sorted(map(tuple, pii.find_spans(frame(spark, rows)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "spans", "n_added").collect()), key=str)
    assert got == sorted([(1, 1, 0, 0, 0, "email:0:6", 0)] * 2 + [(2, 0, 0, 0, 0, "", 0), (3, 0, 0, 0, 0, "", 0), (None, 0, 1, 0, 0, "ip:0:8", 0), (4, 0, 0, 0, 1, "phone:2:19", 0)], key=str)
    assert pii.find_spans(frame(spark, [])).count() == 0
    masked = {r.doc_id: r.text for r in pii.redact(frame(spark, rows)).collect()}
    assert masked[1] == "<email> x" and masked[2] is None and masked[4] == "Ü <phone>"
    assert pii.redact(frame(spark, rows)).columns == frame(spark, rows).columns


def test_media_round_trip_and_boxes():
    for n in (0, 1, 191, 192, 193, 192 * 16, 192 * 16 * 3 + 5, 100_001):
        data = random.Random(n).randbytes(n)
        stored = media.pack(data)
        (t,) = media.tracks(stored)
        assert media.payload(stored, t) == media.pad(data) and len(media.pad(data)) % 192 == 0
        assert (t["codec"], t["handler"], t["timescale"], t["duration"]) == ("raw ", "soun", 8000, len(media.pad(data)))
        assert [b - a for a, b in media.key_ranges(t)] == [192] * -(-len(media.pad(data)) // (192 * media.KEY_EVERY))
        for a, b in media.key_ranges(t):
            assert stored[a:b] in media.pad(data)


def test_media_foreign_and_broken_files(spark):
    wide = struct.pack(">I4sQ", 1, b"free", 24) + b"x" * 8
    good = media.pack(b"abc")
    assert media.tracks(good + wide)[0]["codec"] == "raw " and media.tracks(good + struct.pack(">I4s", 0, b"skip") + b"rest")
    rows = [(1, good), (2, good[:300]), (3, b"no container"), (4, None), (5, b""), (None, good)]
    got = {r.id: r for r in media.inspect(spark.createDataFrame(rows, "id long, data binary"), "id", "data").collect()}
    assert got[1].error is None and got[1].keyframes[0].end - got[1].keyframes[0].start == 192 and got[1].n_samples == 1
    assert all(got[i].codec is None and got[i].error for i in (2, 3, 4, 5)) and got[None].codec == "raw "


def test_media_tracks_and_fragments(spark):
    good = media.pack(b"abc")
    path, body, end = next(b for b in media.boxes(good) if b[0] == (b"moov",))
    traks = [good[b[1] - 8 : b[2]] for b in media.boxes(good, body, end) if b[0][-1] == b"trak"]
    second = traks[0].replace(b"soun", b"vide").replace(b"raw ", b"avc1")
    # The boxes before the media data keep their place: the longer moov comes at the end, a free box stands where it was.
    longer = good[: body - 4] + b"free" + good[body:] + media._box(b"moov", good[body:end], second)
    rows = [(1, longer), (2, good + media._box(b"moof", media._box(b"traf")))]
    got = {r.id: r for r in media.inspect(spark.createDataFrame(rows, "id long, data binary"), "id", "data").collect()}
    assert [(t.codec, t.handler, t.n_samples, len(t.keyframes)) for t in got[1].tracks] == [("raw ", "soun", 1, 1), ("avc1", "vide", 1, 1)]
    assert got[1].codec == "raw " and got[1].error is None
    assert len(got[2].tracks) == 1 and "fragmented" in got[2].error


def test_media_fragments_are_decoded(spark):
    """A file of two fragments, built by hand: sizes per sample, default sizes, sync marks, both ways to give an offset."""
    movie = media.pack(b"abc")
    path, body, end = next(b for b in media.boxes(movie) if b[0] == (b"moov",))
    trex = media._box(b"mvex", media._full(b"trex", struct.pack(">5I", 1, 1, 10, 4, 0x10000)))
    head = movie[: body - 8] + media._box(b"free", movie[body:end]) + movie[end:]
    out = head + media._box(b"moov", movie[body:end], trex)
    # The first samples stay where the moved tables point to.
    one = lambda offset: media._box(b"moof", media._full(b"mfhd", struct.pack(">I", 1)), media._box(b"traf", media._full(b"tfhd", struct.pack(">I", 1), flags=0x20000), media._full(b"trun", struct.pack(">IiI", 3, offset, 0), struct.pack(">3I", 5, 6, 7), flags=0x1 | 0x4 | 0x200)))
    first = len(out) + len(one(0)) + 8
    out += one(len(one(0)) + 8) + media._box(b"mdat", b"A" * 18)
    base = len(out)
    two = lambda at: media._box(b"moof", media._box(b"traf", media._full(b"tfhd", struct.pack(">IQ", 1, at), flags=0x1), media._full(b"trun", struct.pack(">I", 2), struct.pack(">2I", 0x10000, 0), flags=0x400), media._full(b"trun", struct.pack(">I", 1), flags=0)))
    second = base + len(two(0)) + 8
    out += two(second) + media._box(b"mdat", b"B" * 12)
    (t,) = media.tracks(out)
    assert t["samples"][1:] == [(first, 5), (first + 5, 6), (first + 11, 7), (second, 4), (second + 4, 4), (second + 8, 4)]
    assert media.key_ranges(t)[1:] == [(first, first + 5), (second + 4, second + 8)]
    assert media.payload(out, t) == media.pad(b"abc") + b"A" * 18 + b"B" * 12
    unknown = media._box(b"moof", media._box(b"traf", media._full(b"tfhd", struct.pack(">I", 9))))
    got = {r.id: r for r in media.inspect(spark.createDataFrame([(1, out), (2, out + unknown)], "id long, data binary"), "id", "data").collect()}
    assert got[1].error is None and got[1].n_samples == 7 and "unknown track 9" in got[2].error


def test_media_digest_keyframes(spark):
    """Key frames by plain arithmetic: the payload ends the file, and each KEY_EVERY-th frame of it is one."""
    texts = ["", "x" * 191, "é" * 5_000, "word " * 20_000]
    for r in media.media_digest(frame(spark, list(enumerate(texts)))).collect():
        frames = range(0, r.payload_bytes // media.FRAME, media.KEY_EVERY)
        start = r.media_bytes - r.payload_bytes
        assert [(k.start, k.end) for k in r.keyframes] == [(start + i * media.FRAME, start + (i + 1) * media.FRAME) for i in frames]
        assert (r.codec, r.duration) == ("raw ", r.payload_bytes)
    assert media.media_digest(frame(spark, [])).count() == 0 and media.inspect(spark.createDataFrame([], "id long, data binary"), "id", "data").count() == 0


def test_media_digest(spark):
    rows = [(1, "é" * 300), (2, "é" * 300), (3, None), (4, ""), (4, "")]
    got = {r.doc_id: r for r in media.media_digest(frame(spark, rows)).collect()}
    padded = media.pad("é".encode() * 300)
    assert (got[1].n_bytes, got[1].payload_bytes, got[1].payload_sha256) == (600, 768, hashlib.sha256(padded).hexdigest())
    assert got[1].tail_crc32 == zlib.crc32(padded[-16:]) and got[1][1:] == got[2][1:] and got[3][1:] == got[4][1:] and got[3].payload_bytes == 192


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "  ", "\n", "  a  b \n\n c\t d ", "a" * 3000, "ab" * 129, "x \xa0 y\xa0 z", "x\x1c y \x1c z\x85 q", "s don't  'll\n 're", "日本 語🙂🙂", "é́ ñ", "123 4567 8", "a  b", "<|endoftext|>", " lead", "trail  "]


def test_bpe_equals_library(spark, tokenizer):
    path, pattern, library = tokenizer
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()][:120] + ODD
    coder = bpe.Coder.shared(path, pattern)
    for text, parts in zip(texts, coder.encode(texts), strict=True):
        ids = [int(i) for p in parts for i in p[0].split(",")]
        assert ids == library.encode_ordinary(text) and "".join(p[1] for p in parts).encode("latin-1") == text.encode(), text[:50]
    words = ["".join(random.Random(n).choices(letters, k=n)).encode() for letters in ("ab", "abcdeéü", "thequickbrownfox日本") for n in (2, 50, 129, 257, 2000)] + [b"a" * n for n in (129, 130, 255, 256, 1001)]
    for word, (ids, decoded) in zip(words, coder.encode_words(words), strict=True):
        assert [int(i) for i in ids.split(",")] == library._encode_single_piece(word) and decoded.encode("latin-1") == word


def test_bpe_long_words_in_bounded_rounds(tokenizer, monkeypatch):
    """Few rounds a query and many: the same tokens."""
    path, pattern, library = tokenizer
    coder = bpe.Coder.shared(path, pattern)
    words = ["".join(random.Random(n).choices("aabcdeé", k=n)).encode() for n in (200, 333)] + [b"a" * 300, b"ab" * 150]
    want = [library._encode_single_piece(w) for w in words]
    plain = lambda: [[int(i) for i in ids.split(",")] for ids, _ in coder.encode_words(words)]
    assert plain() == want
    monkeypatch.setattr(bpe, "ROWS_A_QUERY", 5_000)
    assert plain() == want
    monkeypatch.undo()
    word = "".join(random.Random(1).choices("etaoinshrdlu", k=20_000)).encode()
    assert [int(i) for i in coder.encode_words([word])[0][0].split(",")] == library._encode_single_piece(word)


def test_bpe_frames(spark, tokenizer):
    path, pattern, library = tokenizer
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, None), (None, "null id"), (3, ODD[3])]
    got = bpe.encode(frame(spark, rows), path, pattern).collect()
    assert sorted((r.doc_id is None, r.doc_id, list(r.ids), bytes(r.decoded)) for r in got if r.doc_id is not None) == sorted((False, i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows if i is not None)
    digest = {r.doc_id: r for r in bpe.encode_digest(frame(spark, rows), path, pattern).collect()}
    assert digest[4].ids_sha256 == hashlib.sha256(",".join(map(str, library.encode_ordinary(ODD[4]))).encode()).hexdigest()
    assert bpe.encode_digest(frame(spark, []), path, pattern).count() == 0


def toxic_rows(spark, n=300):
    rng = random.Random(1)
    base = ["the", "house", "river", "walks", "green", "stone", "over", "light", "paper", "idea", "seven", "older"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = rng.choices(base, k=40)
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["blorkish", "blorky,", "Blorks", "zzgump"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out_and_clean(spark):
    docs, labels = toxic_rows(spark)
    df = frame(spark, docs + [(1000, None), (1001, ""), (None, "the house")])
    model = toxicity.train(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in docs)
    assert all(got[i].predicted == int(i % 4 == 0) for i, _ in docs if got[i].held_out)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1000].score == got[1001].score and got[1000].predicted == 0
    clean = toxicity.keep_clean(df, model)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if not r.predicted}
    # The score looks at nothing but the text.
    other = toxicity.score(frame(spark, [(7, docs[0][1])]), model).first()
    assert other.score == got[0].score


def test_toxicity_without_labels(spark):
    docs, labels = toxic_rows(spark, 20)
    for none in (labels.limit(0), labels.withColumn("toxic", F.lit(0))):
        model = toxicity.train(frame(spark, docs), none)
        assert {r.predicted for r in toxicity.score(frame(spark, docs), model).collect()} == {0}


def test_toxicity_model_equals_plain_counts():
    """Steps of the model against Kneser-Ney estimates from dictionaries."""
    rng = random.Random(5)
    forms = list({"".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(120)})
    seen = [Counter({f: rng.randint(0, 3) for f in rng.sample(forms, 80)}) for _ in (0, 1)]
    n, d, strength = toxicity.ORDER, toxicity.DISCOUNT, toxicity.STRENGTH
    count = [Counter(), Counter()]
    for c in (0, 1):
        for f, k in seen[c].items():
            s = f"\t{f}\n"
            for i in range(2, len(s) + 1):
                if k:
                    count[c][s[max(0, i - n) : i]] += k
    both = count[0] + count[1]
    grams = sorted(both)
    # An n-gram that is a suffix on several levels is counted once for each different symbol before it.
    follows = {}
    for g in {g[i:] for g in grams for i in range(len(g) - 1)}:
        follows.setdefault(g[1:], set()).add(g[0])
    continued = Counter({g: len(x) for g, x in follows.items()})
    alphabet = sum(len(g) == 1 for g in continued)

    def low(h, x):
        up = low(h[1:], x) if h else 1 / alphabet
        after = {g: k for g, k in continued.items() if len(g) == len(h) + 1 and g[:-1] == h}
        return (max(continued[h + x] - d, 0) + d * len(after) * up) / sum(after.values()) if after else up

    def step(h, x):
        after = [{g: k for g, k in t.items() if g[:-1] == h} for t in (*count, both)]
        if not after[2]:
            return 0.0
        shared = (max(both[h + x] - d, 0) + d * len(after[2]) * low(h[1:], x)) / sum(after[2].values())
        p = [(max(t[h + x] - d, 0) + (d * len(a) + strength) * shared) / (sum(a.values()) + strength) for t, a in zip(count, after, strict=False)]
        return math.log(p[1] / p[0]) if both[h + x] else math.log((d * len(after[1]) + strength) / (sum(after[1].values()) + strength) / (d * len(after[0]) + strength) * (sum(after[0].values()) + strength))

    model = toxicity._ratios(toxicity._shared(grams), np.array([[count[0][g], count[1][g]] for g in grams]))
    words = forms[:40] + ["abcabcabcabcabc", "x", "axb", "zz"]
    want = []
    for w in words:
        s = f"\t{w}\n"
        want.append(sum(step(s[max(0, i - n + 1) : i], s[i]) for i in range(1, len(s))))
    assert model.of_forms(words) == pytest.approx(want, abs=1e-4)
    assert model.of_forms(["", "a"])[0] == 0


@pytest.mark.parametrize(("scale", "least"), [("0.01", 0.7), ("0.1", 0.9)])
def test_toxicity_recall_on_held_out_rows(spark, scale, least):
    """Held-out labelled rows. About one toxic label in twelve (more in the small table) marks a text without any toxic word, which bounds what can be found."""
    folder = f"/root/testdata/sf{scale}"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()
    shares = {r.toxic: r.share for r in got}
    assert shares[1] >= least and shares[0] <= 0.01


def test_toxicity_edges(spark):
    docs, labels = toxic_rows(spark)
    model = toxicity.train(frame(spark, docs), labels)
    assert toxicity.score(frame(spark, []), model).count() == 0 and toxicity.keep_clean(frame(spark, []), model).count() == 0
    assert toxicity.train(frame(spark, []), labels).weights[:-1].any() == False  # noqa: E712
    # The end of a long word counts as much as its start; very long and odd texts have scores.
    long = model.ratios.of_forms(["x" * 500 + "blorkish", "x" * 500])
    assert long[0] != long[1]
    texts = ["blorky " * 100_000, "a" * 300_000, "\ud83d\ude42 \x00 ... !!!", "..."]
    assert all(0 <= r.score <= 1 for r in toxicity.score(frame(spark, list(enumerate(texts))), model).collect())


def test_toxicity_tables_of_the_driver_are_small():
    """pipeline: the driver held every n-gram as a string and 16 hashes of each at once, and each fold had hashes of its own."""
    rng = np.random.default_rng(5)
    grams = sorted({"\t" + "".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 8, 150_000)})
    counts = rng.integers(0, 3, (len(grams), 2)).astype(np.int32)
    tracemalloc.start()
    try:
        shared = toxicity._shared(grams)
        folds = [toxicity._ratios(shared, counts) for _ in range(toxicity.FOLDS)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 250 * len(grams)
    assert all(f.grams is folds[0].grams and f.contexts is folds[0].contexts for f in folds)
