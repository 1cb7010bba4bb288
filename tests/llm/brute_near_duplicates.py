"""Compares near_duplicates with all pairs, on a whole table: python tests/llm/brute_near_duplicates.py DIR.

Shingles are strings of words here, numbered as they come; all pairs of documents
whose set sizes allow a link are counted, in tiles.
"""

import os
import re
import sys

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
TILE = 512


def exact_components(path):
    table = pq.read_table(f"{path}/documents.parquet", columns=["doc_id", "text"])
    number, sets, ids = {}, {}, {}
    for doc, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True):
        w = WORD.findall((text or "").translate(LOWER))
        found = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        key = np.array(sorted(number.setdefault(x, len(number)) for x in found), np.int64)
        ids.setdefault(key.tobytes(), []).append(doc)
        sets[key.tobytes()] = key
    up = {}

    def root(x):
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    keys = sorted((k for k in sets if len(sets[k])), key=lambda k: len(sets[k]))
    size = np.array([len(sets[k]) for k in keys])
    for i in range(0, len(keys), TILE):
        p = [sets[k] for k in keys[i : i + TILE]]
        flat_p = np.concatenate(p)
        vocab, place = np.unique(flat_p, return_inverse=True)
        left = np.repeat(np.arange(len(p)), [len(x) for x in p])
        for j in range(i, len(keys), TILE):
            if size[j] * 75 > 100 * size[min(i + TILE, len(keys)) - 1]:
                break
            q = [sets[k] for k in keys[j : j + TILE]]
            flat_q = np.concatenate(q)
            at = np.minimum(np.searchsorted(vocab, flat_q), len(vocab) - 1)
            on = vocab[at] == flat_q
            if not on.any():
                continue
            right = np.repeat(np.arange(len(q)), [len(x) for x in q])[on]
            used, at = np.unique(at[on], return_inverse=True)
            back = np.full(len(vocab), -1)
            back[used] = np.arange(len(used))
            mine = back[place]
            inter = np.zeros((len(p), len(q)), np.float32)
            for c in range(0, len(used), 4096):
                x, y = np.zeros((len(p), 4096), np.float32), np.zeros((len(q), 4096), np.float32)
                a = (mine >= c) & (mine < c + 4096)
                x[left[a], mine[a] - c] = 1
                b = (at >= c) & (at < c + 4096)
                y[right[b], at[b] - c] = 1
                inter += x @ y.T
            union = size[i : i + len(p)][:, None] + size[j : j + len(q)][None, :] - inter
            for u, v in zip(*np.nonzero(100 * inter >= 75 * union), strict=True):
                x, y = root(i + int(u)), root(j + int(v))
                up[max(x, y)] = min(x, y)
    least = {}
    for k, key in enumerate(keys):
        least[root(k)] = min(least.get(root(k), 2**63), min(ids[key]))
    out = {d: (len(sets[key]), least[root(k)]) for k, key in enumerate(keys) for d in ids[key]}
    return out | {d: (0, d) for d in ids.get(b"", [])}


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from factlake.llm import minhash

    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "16").getOrCreate()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.read.parquet(f"{sys.argv[1]}/documents.parquet")).collect()}
    want = exact_components(sys.argv[1])
    print(f"{len(want)} documents, {len({c for _, c in want.values()})} components, {sum(got[k] != v for k, v in want.items())} documents differ")
