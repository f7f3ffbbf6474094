"""Media columns: texts stored as lossless WebP, read back, and described.

A text's UTF-8 bytes, padded with bytes 255 to a positive multiple of 576, are the green
samples of an image 576 wide; longer ones are frames of eight lines of an animation.
What a frame repeats of itself is stored as back-references.
Features come from the samples that were read back.  Null texts are empty.  Equal texts
have equal values.  Repeated rows are repeated in the result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, text_buffers
from .webp import WIDTH, decode_planes, encode_planes

PAD = 255


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows filled up to multiples of WIDTH, and their offsets."""
    size = np.diff(offsets)
    full = np.maximum(-(-size // WIDTH), 1) * WIDTH
    edges = np.r_[0, np.cumsum(full)]
    out = np.full(edges[-1], PAD, np.uint8)
    out[np.arange(len(data)) + np.repeat(edges[:-1] - offsets[:-1], size)] = data
    return out, edges


def features(samples: np.ndarray) -> str:
    """Mean, deviation, mean step along the lines, and a 64-bit hash of which of 64 stretches are above the mean."""
    x = samples.astype(np.float64)
    step = np.abs(np.diff(x.reshape(-1, WIDTH), axis=1)).mean()
    stretch = x.reshape(64, -1).mean(axis=1)
    code = int.from_bytes(np.packbits(stretch > x.mean()).tobytes(), "big")
    return f"mean={x.mean():.4f};std={x.std():.4f};step={step:.4f};hash={code:016x}"


def stored_rows(docs: DataFrame, keep_file: bool = False) -> DataFrame:
    """Digests and features of each row of docs; keep_file adds the file itself as `media`."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = text_buffers(b.column("text"))
            files = encode_planes(*padded(data, offsets))
            planes = decode_planes(files)
            read = [p.tobytes() for p in planes]
            columns = {
                "n_bytes": pa.array(np.diff(offsets)),
                "payload_bytes": pa.array([len(x) for x in read], pa.int64()),
                "payload_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in read]),
                "tail_crc32": pa.array([zlib.crc32(x[-32:]) for x in read], pa.int64()),
                "media_bytes": pa.array([len(f) for f in files], pa.int64()),
                "media_sha256": pa.array([hashlib.sha256(f).hexdigest() for f in files]),
                "feature": pa.array([features(p) for p in planes]),
            }
            if keep_file:
                columns["media"] = pa.array(files, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns.values()], ["doc_id", *columns])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return docs.select("doc_id", "text").mapInArrow(make, schema + ", media binary" * keep_file)


def query(docs: DataFrame) -> DataFrame:
    return stored_rows(docs)
