"""Privacy encoding of genotypes and phenotypes: a secret matrix and its inverse that tasks make block by block."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Samples of a block on average, features that are encoded at once, and most samples of a block in the codes of encoded ones.
SIZE, ROWS, PLACES = 64, 1024, 1 << 20


def secret_matrix(secret: bytes, turn: int, block: int, n: int) -> np.ndarray:
    """n x n integers from 1 to 9 from a keyed stream of SHAKE-256, the first well-conditioned ones."""
    for attempt in range(1_000):
        stream, size = b"", 2 * n * n + 64
        while len(stream) < n * n:
            raw = np.frombuffer(hashlib.shake_256(secret + f"/{turn}/{block}/{attempt}/{size}".encode()).digest(size), np.uint8)
            stream, size = (raw[raw < 252] % 9 + 1).astype(np.uint8).tobytes(), 2 * size
        m = np.frombuffer(stream[: n * n], np.uint8).reshape(n, n).astype(float)
        if np.linalg.cond(m) < 1e6:
            return m
    raise ValueError(f"no well-conditioned matrix of {n} samples was found")


def _block(secret: bytes, turn: int, name: str, parts: int) -> Column:
    text = F.concat(F.lit(f"{secret.hex()}/{turn}/"), F.col(name).cast("string"))
    return (F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long") % parts).cast("int")


def _encoder(row: str, secret: bytes, turn: int, inverse: bool) -> Callable:
    """Encodes the cells of a tile by its block's matrix."""

    def run(key: tuple, cell: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(known["__name"].to_numpy())
        rows, i = np.unique(cell[row].to_numpy(), return_inverse=True)
        x = np.zeros((len(rows), len(ids)))
        if len(ids) and len(rows):
            j = np.searchsorted(ids, cell["__name"].to_numpy()).clip(max=len(ids) - 1)
            good = ids[j] == cell["__name"].to_numpy()
            x[i[good], j[good]] = np.nan_to_num(cell["__v"].to_numpy(float))[good]
            m = secret_matrix(secret, turn, int(key[1]), len(ids))
            x = np.linalg.solve(m, x.T).T if inverse else x @ m
        a, b = np.indices(x.shape)
        return pd.DataFrame({row: rows[a.ravel()], "__name": int(key[1]) * PLACES + b.ravel(), "__v": x.ravel()})

    return run


def encode(values: DataFrame, samples: DataFrame, secret: bytes, inverse: bool, turns: int = 2, row: str = "feat", value: str = "x") -> DataFrame:
    """(row, code, value): genotypes G F, or with `inverse` phenotypes F**-1 Y, so that products over the codes are those of G and Y.

    values: (row, iid, value), null or absent cells being 0: fill them before. samples: (iid), all of them, the same for both sides.
    F is a product of `turns` factors, each block-diagonal with random integers from 1 to 9 over blocks of SIZE samples or
    so, which the secret deals anew every turn; so each code mixes SIZE ** turns samples. A task makes the matrix of its block from the
    secret and encodes a tile of features by it; nothing reaches the driver. Use a fresh secret of 16 random bytes
    or more for a study (secrets.token_bytes) and don't pass it on.
    """
    parts = max(1, -(-samples.count() // SIZE))
    features = max(1, -(-values.agg(F.approx_count_distinct(row)).first()[0] // ROWS))
    kind = dict(values.dtypes)[row]
    order = list(range(turns))
    now = values.select(row, F.col("iid").alias("__name"), F.col(value).cast("double").alias("__v"))
    names = [samples.select(F.col("iid").alias("__name")).distinct()]
    for turn in order:  # the codes of each turn, which don't depend on the values
        sizes = names[-1].groupBy(_block(secret, turn, "__name", parts).alias("b")).agg(F.count("*").alias("n"))
        names.append(sizes.select(F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda j: F.col("b") * F.lit(PLACES).cast("long") + j)).alias("__name")))
    for turn in order:
        there = names[turn].select(_block(secret, turn, "__name", parts).alias("__b"), F.col("__name"))
        lists = there.select("__b", "__name", F.explode(F.sequence(F.lit(0), F.lit(features - 1))).alias("__r"))
        cells = now.select(F.pmod(F.xxhash64(row), F.lit(features)).cast("int").alias("__r"), _block(secret, turn, "__name", parts).alias("__b"), row, "__name", "__v")

        now = cells.groupBy("__r", "__b").cogroup(lists.groupBy("__r", "__b")).applyInPandas(_encoder(row, secret, turn, inverse), f"`{row}` {kind}, __name long, __v double")
    return now.select(row, F.col("__name").alias("code"), F.col("__v").alias(value))
