"""Plain definitions the operators are held against."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def covered(docs: dict, length: int) -> dict:
    """Flags of the units of each document that lie in a window which also starts under a smaller id (None: after all)."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, units in docs.items():
        for k in range(len(units) - length + 1):
            name = bytes(units[k : k + length]) if isinstance(units, bytes) else tuple(units[k : k + length])
            first[name] = min(first.get(name, i), i, key=key)
    out = {}
    for i, units in docs.items():
        gone = bytearray(len(units))
        for k in range(len(units) - length + 1):
            name = bytes(units[k : k + length]) if isinstance(units, bytes) else tuple(units[k : k + length])
            if key(first[name]) < key(i):
                gone[k : k + length] = b"\1" * length
        out[i] = bytes(gone)
    return out


def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}
