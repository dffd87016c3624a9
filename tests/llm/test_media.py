import hashlib
import zlib

import numpy as np

from postalith.llm import media

TEXTS = ["", None, "abc", "x" * 64, "ä" * 500, "the quick brown fox " * 4000, "abc"]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "clash", b"old") for i, t in enumerate(texts)], "doc_id long, text string, landmarks string, media binary")


def test_round_trip_of_odd_texts(spark):
    rows = media.fingerprint(media.encode(frame(spark))).orderBy("doc_id").collect()
    for text, r in zip(TEXTS, rows):
        raw = (text or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert media.from_wav(bytes(r["media"])) == payload
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-64:])
    assert rows[2]["landmarks"] == rows[6]["landmarks"] and len(rows[5]["landmarks"]) > 0


def test_null_media_and_empty_table(spark):
    one = spark.createDataFrame([(1, None)], "doc_id long, media binary")
    assert media.fingerprint(one).first()["payload_sha256"] is None
    assert media.fingerprint(media.encode(frame(spark, []))).count() == 0


def test_peaks_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    samples = rng.integers(0, 256, 300_000).astype(np.uint8)
    whole = media.peaks(samples)
    monkeypatch.setattr(media, "BLOCK", 37)
    assert all((a == b).all() for a, b in zip(whole, media.peaks(samples)))


def test_landmarks_equal_brute_force():
    rng = np.random.default_rng(5)
    tone = 100 + 20 * np.sin(np.arange(6000) * 0.3) + rng.integers(0, 30, 6000)
    samples = np.concatenate([tone, np.zeros(900), rng.integers(0, 256, 2500)]).astype(np.uint8)
    samples = samples[: len(samples) // 64 * 64]
    count = max(1, -(-(len(samples) - media.WINDOW) // media.HOP) + 1)
    power = media._power(samples, 0, count)
    found = []
    for t in range(count):
        for f in range(power.shape[1]):
            v = power[t, f]
            bins = slice(max(0, f - media.NEAR_BINS), f + media.NEAR_BINS + 1)
            near, earlier = power[max(0, t - media.NEAR_FRAMES) : t + media.NEAR_FRAMES + 1, bins], power[max(0, t - media.NEAR_FRAMES) : t, bins]
            if v == near.max() and v > earlier.max(initial=-1) and v > media.LOUD * power[t].mean() and v > 1e-3:
                found.append((t, f))
    want = sorted(
        (t, f << 15 | g << 6 | u - t)
        for i, (t, f) in enumerate(found) for u, g in found[i + 1 : i + 1 + media.FAN_OUT] if u - t <= media.REACH
    )
    time, code = media.landmarks(samples.tobytes())
    assert len(want) > 20 and list(zip(time.tolist(), code.tolist())) == want


def test_a_tone_is_found():
    t = np.arange(8000)
    samples = (128 + 60 * np.sin(2 * np.pi * 1000 * t / media.RATE)).astype(np.uint8)
    _, bins = media.peaks(samples)
    assert len(bins) and np.bincount(bins).argmax() == 1000 * media.WINDOW // media.RATE - 1
