"""Media columns: WAV bytes read by the wave module, and spectral-peak pair fingerprints.

A landmark is a pair of spectral peaks: the anchor's frame number (its time code) and a code that holds both
frequencies and the distance in frames. The landmarks of a recording are an array of structs (time, code).
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Samples in a frame and between frames; frames and bins to each side over which a peak must be the largest.
WINDOW, HOP, NEAR_FRAMES, NEAR_BINS = 512, 256, 5, 12
#: A peak exceeds this many times its frame's mean power; an anchor pairs with the next FAN_OUT peaks within REACH frames.
LOUD, FAN_OUT, REACH = 3.0, 3, 63
#: Frames whose spectra are held at a time.
BLOCK = 2048
RATE = 8000

LANDMARKS = T.ArrayType(T.StructType([T.StructField("time", T.IntegerType()), T.StructField("code", T.IntegerType())]))
_PA_LANDMARKS = pa.list_(pa.struct([("time", pa.int32()), ("code", pa.int32())]))


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """One channel of unsigned 8-bit samples, a sample for each byte."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if w.getnchannels() != 1 or w.getsampwidth() != 1:
            raise ValueError("one channel of 8-bit samples is expected")
        return w.readframes(w.getnframes())


_HANN = np.hanning(WINDOW).astype(np.float32)


def _power(samples: np.ndarray, first: int, last: int) -> np.ndarray:
    """Power spectra of frames first..last-1, without the constant term; the end is padded with silence."""
    part = samples[first * HOP : (last - 1) * HOP + WINDOW]
    part = np.pad(part, (0, (last - first - 1) * HOP + WINDOW - len(part)), constant_values=128)
    frames = np.lib.stride_tricks.sliding_window_view(part.astype(np.float32), WINDOW)[::HOP]
    frames = (frames - frames.mean(axis=1, keepdims=True)) * _HANN
    spectrum = np.fft.rfft(frames, axis=1)[:, 1:]
    return spectrum.real**2 + spectrum.imag**2


def _doubling(x: np.ndarray, reach: int, axis: int) -> np.ndarray:
    """Maximum over -reach..+reach along the axis, by windows of doubled width."""
    x = np.moveaxis(x, axis, 0)
    width = 2 * reach + 1
    pad = np.full((reach,) + x.shape[1:], -1, dtype=x.dtype)
    run, have = np.concatenate([pad, x, pad]), 1
    while have < width:
        shift = min(have, width - have)
        run = np.maximum(run[:-shift], run[shift:])
        have += shift
    return np.moveaxis(run, 0, axis)


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame and bin of every spectral peak, by time. Of equal values in a neighbourhood the earliest counts."""
    count = max(1, -(-(len(samples) - WINDOW) // HOP) + 1)
    times, bins = [], []
    for a in range(0, count, BLOCK):
        b = min(count, a + BLOCK)
        lo, hi = max(0, a - NEAR_FRAMES), min(count, b + NEAR_FRAMES)
        power = _power(samples, lo, hi)
        wide = _doubling(power, NEAR_BINS, 1)
        found = (power == wide) & (power > LOUD * power.mean(axis=1, keepdims=True)) & (power > 1e-3)
        around = _doubling(wide, NEAR_FRAMES, 0)
        earlier = np.full_like(wide, -1)
        for d in range(1, NEAR_FRAMES + 1):
            np.maximum(earlier[d:], wide[:-d], out=earlier[d:])
        t, f = np.nonzero((found & (power == around) & (power > earlier))[a - lo : b - lo])
        times.append(t + a)
        bins.append(f)
    return np.concatenate(times), np.concatenate(bins)


def landmarks(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """time and code of each pair of peaks, in order of time, then of code."""
    t, f = peaks(np.frombuffer(payload, dtype=np.uint8))
    time, code = [], []
    for k in range(1, FAN_OUT + 1):
        if len(t) > k:
            dt = t[k:] - t[:-k]
            ok = dt <= REACH
            time.append(t[:-k][ok])
            code.append(((f[:-k] << 15) | (f[k:] << 6) | dt)[ok])
    if not time:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    time, code = np.concatenate(time), np.concatenate(code)
    order = np.lexsort((code, time))
    return time[order].astype(np.int32), code[order].astype(np.int32)


def encode(docs: DataFrame, text: str = "text", rate: int = RATE) -> DataFrame:
    """Add n_bytes and media: the text's UTF-8 bytes, filled up with bytes 0 to a positive multiple of 64, as WAV.

    Null is the empty text, and gives 64 samples of 0. Texts are stored whole, whatever their length; rows alike give
    alike recordings; an empty table gives an empty one. All columns stay, but for earlier ones of these two names.
    """
    kept = docs.drop("n_bytes", "media", "_utf8")
    raw = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    kept = kept.withColumn("_utf8", raw)
    schema = T.StructType([x for x in kept.schema if x.name != "_utf8"] + [T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(batch.schema.get_field_index("_utf8"))
            sizes, media = [], []
            for x in raws:
                x = x.as_py()
                sizes.append(len(x))
                media.append(to_wav(x.ljust(max(64, -(-len(x) // 64) * 64), b"\0"), rate))
            keep = [i for i, n in enumerate(batch.schema.names) if n != "_utf8"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(sizes, pa.int64()), pa.array(media, pa.binary())],
                names=[batch.schema.names[i] for i in keep] + ["n_bytes", "media"],
            )

    return kept.mapInArrow(run, schema)


def fingerprint(media: DataFrame, column: str = "media") -> DataFrame:
    """Read each WAV back and add payload_bytes, payload_sha256, tail_crc32 (last 64 bytes) and landmarks.

    A null recording gives null in all four. Equal bytes give equal landmarks. All other columns stay.
    """
    new = ["payload_bytes", "payload_sha256", "tail_crc32", "landmarks"]
    kept = media.drop(*new)
    schema = T.StructType([*kept.schema, T.StructField(new[0], T.LongType()), T.StructField(new[1], T.StringType()), T.StructField(new[2], T.LongType()), T.StructField(new[3], LANDMARKS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, tail, lists = [], [], [], [0]
            times, codes, missing = [], [], []
            for x in batch.column(batch.schema.get_field_index(column)):
                x = x.as_py()
                missing.append(x is None)
                if x is None:
                    size.append(None), digest.append(None), tail.append(None), lists.append(lists[-1])
                    continue
                payload = from_wav(x)
                size.append(len(payload))
                digest.append(hashlib.sha256(payload).hexdigest())
                tail.append(zlib.crc32(payload[-64:]))
                t, c = landmarks(payload)
                times.append(t), codes.append(c), lists.append(lists[-1] + len(t))
            flat = [np.concatenate(v) if v else np.zeros(0, np.int32) for v in (times, codes)]
            pairs = pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in flat], fields=list(_PA_LANDMARKS.value_type))
            marks = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pairs, type=_PA_LANDMARKS, mask=pa.array(missing) if any(missing) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(size, pa.int64()), pa.array(digest, pa.string()), pa.array(tail, pa.int64()), marks],
                names=[*batch.schema.names, *new],
            )

    return kept.mapInArrow(run, schema)
