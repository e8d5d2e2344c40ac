"""Media columns: payloads stored as WAV, and spectral-peak fingerprints of the samples.

`store` turns texts into 8-bit mono WAV files in a binary column; `fingerprint` reads such
a column with the wave module. Samples are cut into overlapping frames, a short-time
Fourier transform gives each frame's spectrum, and the strongest peaks of a frame are
paired with those of the frames after it. A pair (two frequencies and their distance in
time) is a hash, stored with the frame in which it starts.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpusmill.llm.common import stash, table

BLOCK = 64
RATE = 8000
FRAME = 64
HOP = 32
PEAKS = 3
REACH = 3  # frames ahead in which a peak finds its partners
FLOOR = 1 / 32  # of a frame's strongest peak; weaker ones are noise
_WINDOW = np.hanning(FRAME + 2)[1:-1].astype(np.float32)
_SLAB = 2048  # frames transformed at once
_ROWS = 100  # rows whose pairs are held at once


def to_wav(payload: bytes) -> bytes:
    """8-bit mono PCM; a sample is a byte, so that any payload comes back unchanged."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    with wave.open(io.BytesIO(data), "rb") as w:
        if w.getnchannels() != 1 or w.getsampwidth() != 1:
            raise ValueError("8-bit mono samples expected")
        return w.readframes(w.getnframes())


def pad(raw: bytes) -> bytes:
    """Zero bytes up to a positive multiple of BLOCK."""
    return raw + b"\0" * ((-len(raw)) % BLOCK if raw else BLOCK)


def peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frequency bins of the PEAKS strongest local maxima of each frame, and their strength."""
    x = np.frombuffer(samples, np.uint8)
    x = np.full(1, 128, np.uint8) if len(x) == 0 else x
    n = -(-(len(x) + FRAME - 2 * HOP) // HOP) + 1
    before = FRAME - HOP
    # The ends are held, so that every sample lies in as many frames as those in the middle.
    full = np.pad(x, (before, (n - 1) * HOP + FRAME - before - len(x)), "edge")
    bins, power = np.zeros((n, PEAKS), np.int64), np.zeros((n, PEAKS), np.float32)
    views = np.lib.stride_tricks.sliding_window_view(full, FRAME)[::HOP]
    for at in range(0, n, _SLAB):
        part = views[at : at + _SLAB].astype(np.float32)
        part = (part - part.mean(axis=1, keepdims=True)) * _WINDOW
        spec = np.abs(np.fft.rfft(part, axis=1))
        inner = spec[:, 1:-1]
        inner = np.where((inner > spec[:, :-2]) & (inner >= spec[:, 2:]), inner, 0)
        for p in range(PEAKS):
            best = inner.argmax(axis=1)
            rows = np.arange(len(best))
            bins[at : at + len(best), p] = best + 1
            power[at : at + len(best), p] = inner[rows, best]
            inner[rows, best] = 0
    power[power < power[:, :1] * np.float32(FLOOR)] = 0
    return bins, power


def pairs(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(time, hash) of each pair of peaks: first bin, second bin and frames between."""
    bins, power = peaks(samples)
    times, codes = [], []
    for step in range(1, REACH + 1):
        if len(bins) <= step:
            break
        for p in range(PEAKS):
            for q in range(PEAKS):
                real = (power[:-step, p] > 0) & (power[step:, q] > 0)
                at = np.flatnonzero(real)
                times.append(at)
                codes.append((bins[at, p] << 10) | (bins[at + step, q] << 2) | step)
    if not times:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.sort((np.concatenate(times) << 16) | np.concatenate(codes))  # codes have 16 bits
    return key >> 16, key & 0xFFFF


def store(docs: DataFrame) -> DataFrame:
    """Columns of docs with `n_bytes` and `media` (a WAV file) added or replaced.

    A null text is stored like an empty one: BLOCK zero bytes. Texts are stored whole, repeated
    rows each. No rows give no rows.
    """
    docs = docs.drop("n_bytes", "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(x.as_py() or "").encode() for x in batch.column("text")]
            new = [pa.array(map(len, raw), pa.int64()), pa.array([to_wav(pad(x)) for x in raw], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "n_bytes", "media"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("n_bytes", "long").add("media", "binary"))


_PLAIN = {
    "payload_bytes": pa.int64(),
    "payload_sha256": pa.string(),
    "tail_crc32": pa.int64(),
    "media_bytes": pa.int64(),
    "media_sha256": pa.string(),
    "feature": pa.string(),
}
_READ = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
)
_ARRAYS = ", fingerprint array<struct<time:int,hash:int>>"


def digest(times: np.ndarray, codes: np.ndarray) -> str:
    """The number of pairs, and the SHA-256 of their times and hashes as 32-bit numbers."""
    return f"{len(times)}:{hashlib.sha256(np.stack([times, codes], axis=1).astype('<i4').tobytes()).hexdigest()}"


def fingerprint(df: DataFrame, arrays: bool = True) -> DataFrame:
    """Columns of df, without `media`, with what the WAV files in that column hold.

    payload_bytes, payload_sha256, tail_crc32 (last BLOCK bytes), media_bytes,
    media_sha256, `feature` (the digest of all pairs) and, with `arrays`, `fingerprint`, an array
    of (time, hash) in order. Input columns with these names are replaced. A null media gives
    nulls and an empty fingerprint; data that is no 8-bit mono WAV raises. Silence and
    other constant payloads have no pairs. Long payloads are transformed in slabs; equal
    payloads, repeated rows among them, have equal fingerprints. No rows give no rows.
    """
    df = df.drop(*_PLAIN, "fingerprint")
    added = [*_PLAIN, *(["fingerprint"] if arrays else [])]
    kept = [c for c in df.columns if c != "media"]
    out = StructType([*df.select(*kept).schema.fields, *StructType.fromDDL(_READ + _ARRAYS * arrays).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, _ROWS) for b in batches for i in range(0, b.num_rows, _ROWS)):
            plain: dict[str, list] = {k: [] for k in _PLAIN}
            times, codes, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
            for data in (x.as_py() for x in batch.column("media")):
                t, c = np.zeros(0, np.int64), np.zeros(0, np.int64)
                row = (None,) * len(_PLAIN)
                if data is not None:
                    samples = from_wav(data)
                    t, c = pairs(samples)
                    sha, tail = hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:])
                    row = (len(samples), sha, tail, len(data), hashlib.sha256(data).hexdigest(), digest(t, c))
                for k, v in zip(plain, row, strict=True):
                    plain[k].append(v)
                if arrays:
                    times.append(t)
                    codes.append(c)
                    ends.append(ends[-1] + len(t))
            new = [pa.array(plain[k], t) for k, t in _PLAIN.items()]
            if arrays:
                columns = [pa.array(np.concatenate(x).astype(np.int32)) for x in (times, codes)]
                pair = pa.StructArray.from_arrays(columns, ["time", "hash"])
                new.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pair))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], [*kept, *added])

    return df.mapInArrow(run, out)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint(stash(store(docs).select("doc_id", "n_bytes", "media"), "media"), arrays=False)
