"""Random draws that depend on a row key only.

A draw is the same on every run, in every task and after every retry, which ``rand`` cannot promise once a
lost executor makes Spark compute a partition again. Different salts give independent draws for one key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEX_DIGITS = 13  # 52 bits, the precision of a double
SCALE = float(16 ** HEX_DIGITS)


def uniform_by_key(key: Column, salt: int | str | Column = 0) -> Column:
    """Number in [0, 1) drawn by hashing the key and the salt."""
    salt = salt if isinstance(salt, Column) else F.lit(str(salt))
    digest = F.md5(F.concat_ws(":", key.cast("string"), salt.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(SCALE)


def bernoulli_by_key(key: Column, prob: Column | float, salt: int | str | Column = 0) -> Column:
    """1 with the given probability, else 0; a NULL probability gives 0."""
    prob = prob if isinstance(prob, Column) else F.lit(prob)
    return F.coalesce((uniform_by_key(key, salt) < prob).cast("int"), F.lit(0))


def normal_of(first: Column, second: Column, std: float = 1.0) -> Column:
    """Gaussian noise with mean 0 from two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - first))
    return radius * F.cos(F.lit(2.0 * math.pi) * second) * F.lit(std)


def normal_by_key(key: Column, std: float = 1.0, salt: int | str | Column = 0) -> Column:
    """Gaussian noise with mean 0 from two uniform draws."""
    salt = salt if isinstance(salt, Column) else F.lit(str(salt))
    first, second = (uniform_by_key(key, F.concat(salt.cast("string"), F.lit(part))) for part in "ab")
    return normal_of(first, second, std)


def draw_pairs(names: Sequence[str], first: int, last: int, out: Sequence[str]) -> Callable:
    """Of batches with the text before the salts as their last column, the rows once per number, with the number and the two draws of
    ``normal_by_key`` under the salt ``name:number`` for every name; ``out`` names all columns.

    The MD5 of a whole batch is taken by numpy, a step for all rows at once; the few texts that fill more than one block of it go one by one.
    """
    tails = [[f"{name}:{number}".encode() for name in names] for number in range(first, last + 1)]

    def pairs(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        turns = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
        sines = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]

        def uniform(words):
            """Of blocks as 16 rows of numbers, the first 52 bits of their MD5 as a share of all."""
            start = [np.full(words.shape[1], v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
            a, b, c, d = start
            for i in range(64):
                f, g = [(lambda: d ^ (b & (c ^ d)), i), (lambda: c ^ (d & (b ^ c)), 5 * i + 1), (lambda: b ^ c ^ d, 3 * i + 5), (lambda: c ^ (b | ~d), 7 * i)][i // 16]
                f = f()
                f += a
                f += words[g % 16]
                f += sines[i]
                n = turns[i // 16][i % 4]
                turned = f << np.uint32(n)
                turned |= f >> np.uint32(32 - n)
                turned += b
                a, d, c, b = d, c, b, turned
            high, low = ((x + y).byteswap().astype(np.uint64) for x, y in zip((a, b), start))
            return ((high << np.uint64(20)) | (low >> np.uint64(12))).astype(np.float64) / 2.0 ** 52

        for batch in batches:
            starts = [x.encode() for x in batch.column(batch.num_columns - 1).to_pylist()]
            groups = {}
            for row, size in enumerate(map(len, starts)):
                groups.setdefault(size, []).append(row)
            blocks = {}
            for size, rows in groups.items():
                blocks[size] = block = np.zeros((len(rows), 64), np.uint8)
                block[:, :size] = np.frombuffer(b"".join([starts[row] for row in rows]), np.uint8).reshape(len(rows), size)[:, :64] if size <= 64 else 0
            for number, of_number in enumerate(tails, first):
                found = np.empty((2 * len(of_number), len(starts)))
                for i, tail in enumerate(of_number):
                    for size, rows in groups.items():
                        at = size + len(tail)  # of the last letter
                        if at > 54:
                            for row in rows:
                                for part, letter in enumerate((b"a", b"b")):
                                    found[2 * i + part, row] = int(hashlib.md5(starts[row] + tail + letter).hexdigest()[:13], 16) / 2.0 ** 52
                            continue
                        block = blocks[size]
                        block[:, size:] = np.frombuffer((tail + b"a\x80").ljust(56 - size, b"\0") + (8 * (at + 1)).to_bytes(8, "little"), np.uint8)
                        words = np.ascontiguousarray(block.view("<u4").T)
                        found[2 * i, rows] = uniform(words)
                        words[at // 4] ^= np.uint32((ord("a") ^ ord("b")) << 8 * (at % 4))
                        found[2 * i + 1, rows] = uniform(words)
                numbered = pa.array(np.full(len(starts), number, np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], numbered, *map(pa.array, found)], out)

    return pairs


def repeated_with_draws(df: DataFrame, key: Column, names: Sequence[str], first: int, last: int) -> DataFrame:
    """Every row once per ``_number`` from ``first`` to ``last``, with the draws ``_a0`` and ``_b0`` of the first name, ``_a1`` and ``_b1`` of the next: those of
    ``uniform_by_key`` under the salts ``name:numbera`` and ``name:numberb``, from which ``normal_of`` makes the noise of ``normal_by_key``."""
    draws = [T.StructField(f"_{part}{i}", T.DoubleType()) for i in range(len(names)) for part in "ab"]
    schema = T.StructType([*df.schema.fields, T.StructField("_number", T.IntegerType()), *draws])
    started = df.withColumn("_start", F.coalesce(F.concat(key.cast("string"), F.lit(":")), F.lit("")))
    plain = started.toDF(*[f"_{i}" for i in range(len(started.columns))])  # mapInArrow refuses names with dots
    return plain.mapInArrow(draw_pairs(names, first, last, schema.names), schema)


def fold_by_key(key: Column, folds: int, salt: int | str = "fold") -> Column:
    """Fold number 0 to folds-1."""
    return F.floor(uniform_by_key(key, salt) * F.lit(folds)).cast("int")
