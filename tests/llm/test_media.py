import struct
import zlib

import numpy as np
import pytest

from skygrid.llm import media, queries


def tune(notes):
    return np.concatenate([128 + 100 * np.sin(2 * np.pi * 110 * 2 ** (n / 12) * np.arange(media.SOUND.hop) / media.SOUND.rate) for n in notes]).round().astype(np.uint8).tobytes() if len(notes) else b""


def plain_prints(samples):
    """One recording, frame by frame and area by area."""
    x = np.frombuffer(samples, np.uint8).astype(float) - 128
    frames = []
    for k in range(0, len(x) - media.SOUND.frame + 1, media.SOUND.hop):
        power = np.abs(np.fft.rfft(x[k : k + media.SOUND.frame] * np.hanning(media.SOUND.frame))) ** 2
        chroma = np.zeros(12)
        for i, p in enumerate(power):
            f = i * media.SOUND.rate / media.SOUND.frame
            if f >= 55:
                chroma[int(round(12 * np.log2(f / 440))) % 12] += p
        frames.append(chroma / chroma.sum() if chroma.sum() > 1e-6 else np.zeros(12))
    out = []
    for t in range(len(frames) - media.REACH + 1):
        word = 0
        for one, two in media.filter_areas():
            a, b = (sum(frames[t + i][j] for i in range(r[0], r[1]) for j in range(r[2], r[3])) for r in (one, two))
            bin_ = sum(round(float(np.log((1e-3 + a) / (1e-3 + b))), 6) >= x for x in media.BOUNDS)
            word = word << 2 | (bin_ ^ bin_ >> 1)
        out.append(word)
    return out


def test_prints_against_plain_sums(spark):
    rng = np.random.default_rng(1)
    sounds = [tune(rng.integers(0, 24, n)) for n in (0, 1, 5, 8, 9, 40)] + [rng.integers(0, 256, 5000).astype(np.uint8).tobytes(), b"\x80" * 3000]
    rows = [(i, bytearray(s), 1) for i, s in enumerate(sounds)] + [(50, None, 1)]
    got = {r.id: r for r in media.fingerprints(spark.createDataFrame(rows, "clip long, media binary, prints int"), "clip", "media").collect()}
    for i, s in enumerate(sounds):
        want = plain_prints(s)
        assert [x & 0xFFFFFFFF for x in got[i].prints] == want and got[i].n_prints == len(want)
        assert got[i].prints_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    assert got[50].n_prints == 0


def test_alignment(spark):
    """Shifted, cut and disturbed copies align; other tunes don't; equal ones are a class."""
    rng = np.random.default_rng(2)
    base, other = rng.integers(0, 24, 120), rng.integers(0, 24, 120)
    spoiled = base.copy()
    spoiled[60:63] += 5
    tunes = {1: base, 2: base, 3: base[17:], 4: np.concatenate([rng.integers(0, 24, 9), base]), 5: spoiled, 6: other, 7: rng.integers(0, 24, 90), 8: np.concatenate([other[:20], rng.integers(0, 24, 100)]), 9: []}
    rows = [(i, bytearray(tune(list(n))), 0, "g") for i, n in tunes.items()] + [(10, None, 0, "g"), (11, bytearray(b"\x80" * 9000), 0, "g"), (12, bytearray(b"\x80" * 9000), 0, "g")]
    got = {r.id: (r.group_id, r.class_id) for r in media.aligned(spark.createDataFrame(rows, "clip long, media binary, class_id int, group_id string"), "clip", "media").collect()}
    assert {i: g for i, (g, _) in got.items()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10, 11: 11, 12: 11}
    assert {i: c for i, (_, c) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10, 11: 11, 12: 11}


def test_no_rows_and_repeated_rows(spark):
    rows = [(1, bytearray(tune([1, 5, 9] * 9)))] * 2
    df = spark.createDataFrame(rows, "clip long, media binary")
    assert [(r.id, r.group_id) for r in media.aligned(df, "clip", "media").collect()] == [(1, 1), (1, 1)]
    assert media.aligned(df.where("false"), "clip", "media").count() == 0


def test_sound_of_texts(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id long, text string")
    got = {r.id: bytes(r.media) for r in media.sonified(df, "id", "text").collect()}
    assert len(got[1]) == 3 * media.SOUND.hop and got[1][: media.SOUND.hop] == got[1][2 * media.SOUND.hop :] and got[2] == got[3] == b""
    assert got[1] == tune([zlib.crc32(w.encode()) % 24 for w in "a b a".split()])


@pytest.mark.parametrize("k", range(media.FILTERS))
def test_filters_stay_in_the_image(k):
    for a, b, c, d in media.filter_areas()[k]:
        assert 0 <= a < b <= media.REACH and 0 <= c < d <= media.CLASSES


def groups(spark, tunes):
    rows = [(i, bytearray(tune(list(n)))) for i, n in tunes.items()]
    return {r.id: r.group_id for r in media.aligned(spark.createDataFrame(rows, "clip long, media binary"), "clip", "media").collect()}


def pairs_within(prints, like=media.Likeness()):
    """All pairs of recordings (id: integers) that are equal, or align at any offset at all."""
    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = prints[i], prints[j]
            if np.array_equal(a, b) or any(like.align(a, b, off) for off in range(-len(b) + like.least_overlap, len(a) - like.least_overlap + 1)):
                yield i, j


def brute_groups(prints):
    group = {i: i for i in prints}
    for i, j in pairs_within(prints):
        old, new = max(group[i], group[j]), min(group[i], group[j])
        group = {x: new if g == old else g for x, g in group.items()}
    return group


@pytest.mark.parametrize("block", [1, 128])
def test_groups_of_all_pairs(spark, monkeypatch, block):
    """Cuts, medleys of overlapping pieces and shared openers, against brute force over all pairs."""
    monkeypatch.setattr(media, "BLOCK", block)
    rng = np.random.default_rng(6)
    long, opener = rng.integers(0, 24, 200), rng.integers(0, 24, 30)
    tunes = {1: np.concatenate([long[k : k + 40] for k in (150, 20, 120, 0, 80, 60)]), 2: long, 3: long[9:190]}
    tunes |= {10 + k: np.concatenate([opener, rng.integers(0, 24, 100)]) for k in range(12)}
    tunes |= {30 + k: np.concatenate([tunes[10 + k][4:], rng.integers(0, 24, 8)]) for k in range(6)} | {50: opener, 51: np.repeat([3], 90), 52: np.repeat([3], 70), 53: []}
    got = groups(spark, tunes)
    rows = spark.createDataFrame([(i, bytearray(tune(list(n)))) for i, n in tunes.items()], "clip long, media binary")
    want = brute_groups({r.id: np.array(r.prints, np.int32) for r in media.fingerprints(rows, "clip", "media").collect()})
    assert got == want and got[3] == got[2] == 2 and got[1] == 1 and got[35] == got[50] == 10 and got[52] == 51


def test_groups_of_the_registered_query(spark, sf_dir):
    """No group joins what doesn't align at some offset, and nine tenths at least of all pairs that do are in one group."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id * 1048576 + turn as clip", "text")
    found = {r.id: np.array(r.prints, np.int32) for r in media.fingerprints(media.sonified(turns, "clip", "text"), "id", "media").where("n_prints > 0").collect()}
    got = {r.clip: r.group_id for r in queries.op9_chroma_prints(spark, sf_dir).where("n_prints > 0").collect()}
    want, pairs = brute_groups(found), list(pairs_within(found))
    assert all(want[i] == want[g] for i, g in got.items())
    assert not pairs or np.mean([got[i] == got[j] for i, j in pairs]) >= 0.9


@pytest.mark.parametrize(("noise", "cut"), [(8, 0), (16, 0), (0, 32), (0, 96), (8, 7 * 128 + 16)])
def test_noisy_and_shifted_copies(spark, noise, cut):
    """Copies with noise (16 of 100 turns 5 % of the bits) or cut elsewhere than at a hop (of 128), against all pairs at all offsets."""
    rng = np.random.default_rng(noise + cut)
    rows = []
    for k in range(40):
        raw = np.frombuffer(tune(list(rng.integers(0, 24, 150))), np.uint8)
        copy = np.clip(raw[cut:] + rng.normal(0, noise, len(raw) - cut), 0, 255).round().astype(np.uint8)
        rows += [(2 * k, bytearray(raw.tobytes()), 1), (2 * k + 1, bytearray(copy.tobytes()), 1)]
    df = spark.createDataFrame(rows, "clip long, media binary, n_prints int")
    prints = {r.id: np.array(r.prints, np.int32) for r in media.fingerprints(df, "clip", "media").collect()}
    within = [(i, j) for i, j in ((2 * k + 1, 2 * k) for k in range(40)) if any(media.Likeness().align(prints[i], prints[j], off) for off in range(-100, 101))]
    got = {r.id: r.group_id for r in media.aligned(df, "clip", "media").collect()}
    assert len(within) >= 38 and np.mean([got[i] == got[j] for i, j in within]) >= 0.9
    assert all(g // 2 == i // 2 for i, g in got.items())


def test_pairs_hidden_behind_an_earlier_class(spark):
    """3 and 4 have each common key with 1 or 2, which align with neither."""
    rng = np.random.default_rng(3)
    u, noise = rng.integers(0, 24, 100), rng.integers(0, 24, 100)
    w = u.copy()
    w[48:52] = (w[48:52] + 5) % 24
    assert groups(spark, {1: np.concatenate([u[:50], noise[:50]]), 2: np.concatenate([noise[50:], u[50:]]), 3: u, 4: w}) == {1: 1, 2: 2, 3: 3, 4: 3}


def test_short_recordings_of_equal_bytes(spark):
    assert groups(spark, {1: [3, 4], 2: [3, 5], 3: [3, 4], 4: [], 5: []}) == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_null_ids_and_long_recordings(spark):
    base = np.random.default_rng(5).integers(0, 24, 4000)
    rows = [(None, bytearray(tune(list(base)))), (None, bytearray(b"ab")), (4, bytearray(tune(list(base)))), (5, bytearray(tune(list(base[1000:]))))]
    got = sorted(((r.id, r.group_id, r.n_prints > 1000) for r in media.aligned(spark.createDataFrame(rows, "clip long, media binary"), "clip", "media").collect()), key=str)
    assert got == sorted([(4, 4, True), (5, 4, True), (None, None, False), (None, None, True)], key=str)


def test_wave_files_of_another_rate():
    """A stereo file of 16 bits at four times the rate sounds like the raw samples it was made from."""
    raw = np.frombuffer(tune(list(np.random.default_rng(8).integers(0, 24, 60))), np.uint8)
    body = np.repeat(np.repeat((raw.astype(np.int16) - 128) * 256, 4)[:, None], 2, axis=1).astype("<i2").tobytes()
    file = b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, 4 * media.SOUND.rate, 16 * media.SOUND.rate, 4, 16) + b"data" + struct.pack("<I", len(body)) + body
    assert np.allclose(media.SOUND.samples(file), raw.astype(float) - 128, atol=1e-9)
    assert np.allclose(media.Sound(bits=16).samples(((raw.astype(np.int16) - 128) * 256).astype("<i2").tobytes()), raw.astype(float) - 128)
    assert not len(media.SOUND.samples(b"RIFF0000WAVE")) and not len(media.SOUND.samples(None))
