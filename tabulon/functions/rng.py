"""Counter-based random numbers from md5.

``rand(seed)`` depends on partitioning, so results would change with the
cluster layout. Here a draw is a pure function of (seed, row id, stream):
the same on any number of executors, after a retried task, and reproducible
by any SQL engine that has ``md5`` -- which is what makes sampling, splits,
negatives, bootstrap weights and scenarios checkable against an oracle.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(seed, *parts) -> Column:
    cols = [F.lit(str(seed))] + [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat_ws(":", *cols)


def hash32(seed, *parts) -> Column:
    """Unsigned 32-bit integer: the first 8 hex digits of md5('seed:part1:part2...')."""
    return F.conv(F.substring(F.md5(_key(seed, *parts)), 1, 8), 16, 10).cast("bigint")


def uniform(seed, *parts) -> Column:
    """Uniform in [0, 1)."""
    return hash32(seed, *parts) / F.lit(TWO_32)


def uniform_open(seed, *parts) -> Column:
    """Uniform in (0, 1): safe under ``ln``."""
    return (hash32(seed, *parts) + F.lit(0.5)) / F.lit(TWO_32)


def fast_uniform(seed: int, *parts) -> Column:
    """Uniform in [0, 1) from 53 bits of XXH64 over (seed, parts): a counter
    draw as well, many times cheaper than md5, for draws by the billion. Not
    reproducible in SQL engines without XXH64."""
    cols = [F.lit(int(seed)).cast("bigint")] + [(F.col(p) if isinstance(p, str) else p).cast("bigint") for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def duck_uniform_sql(seed, *parts: str) -> str:
    """The same draw written for the DuckDB oracle."""
    key = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(CAST(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE)"


# Multipliers of the public 32-bit MurmurHash3 finaliser.
MIX = (0x85EBCA6B, 0xC2B2AE35)


def _normal_stages(seed: int, id_col: str, n: int, prefix: str, duck: bool) -> list[list[tuple[str, str]]]:
    """Stages of (name, SQL text) that lead from a row id to ``n`` normals.

    Stream s of an id is the integer finaliser, twice, over the id and
    constants of (seed, s): plain 64-bit arithmetic, so every SQL engine
    agrees on it. Two streams make two normals (Box-Muller). Every stage
    refers to columns of the one before it, so no text grows."""
    low = (1 << 32) - 1
    shift = (lambda h, k: f"({h} >> {k})") if duck else (lambda h, k: f"shiftright({h}, {k})")
    xor = (lambda a, b: f"xor({a}, {b})") if duck else (lambda a, b: f"({a} ^ {b})")
    real = (lambda v: f"{v!r}::DOUBLE") if duck else (lambda v: f"{v!r}D")

    def spread(h, k):
        return xor(h, shift(h, k))

    def times(h, c):  # modulo 2^32 without leaving 64 bits
        return f"(((({h} & 65535) * {c}) + ((({shift(h, 16)} * {c}) & 65535) * 65536)) & {low})"

    streams = range(2 * ((n + 1) // 2))
    const = [[zlib.crc32(f"{seed}:{s}:{k}".encode()) for k in range(2)] for s in streams]
    mix = [lambda h: spread(h, 16), lambda h: times(h, MIX[0]), lambda h: spread(h, 13), lambda h: times(h, MIX[1]), lambda h: spread(h, 16)]
    stages = [[(f"h{s}", xor(f"({id_col} & {low})", str(const[s][0]))) for s in streams]]
    stages += [[(f"h{s}", f(f"h{s}")) for s in streams] for f in mix]
    stages += [[(f"h{s}", f"((h{s} + {const[s][1]} + {shift(id_col, 32)}) & {low})") for s in streams]]
    stages += [[(f"h{s}", f(f"h{s}")) for s in streams] for f in mix]
    open_ = "((h{} + " + real(0.5) + ") / " + real(TWO_32) + ")"
    stages += [[(f"h{s}", f"sqrt({real(-2.0)} * ln({open_.format(s)}))" if s % 2 == 0 else f"({real(2.0 * math.pi)} * {open_.format(s)})")
                for s in streams]]
    stages += [[(f"{prefix}{i}", f"(h{i // 2 * 2} * {'sin' if i % 2 else 'cos'}(h{i // 2 * 2 + 1}))") for i in range(n)]]
    return stages


def counter_normals(df: DataFrame, seed: int, id_col: str, n: int, prefix: str = "z") -> DataFrame:
    """``df`` with ``n`` independent standard normals per row id (>= 0)."""
    keep = [f"`{c}`" for c in df.columns]
    for stage in _normal_stages(seed, id_col, n, prefix, False):
        df = df.selectExpr(*keep, *[f"{text} AS {name}" for name, text in stage])
    return df


def duck_counter_normals_sql(source: str, seed: int, id_col: str, n: int, prefix: str = "z") -> str:
    """DuckDB text of the same normals over ``source``, which holds the id."""
    for k, stage in enumerate(_normal_stages(seed, id_col, n, prefix, True)):
        source = f"SELECT {id_col}, " + ", ".join(f"{text} AS {name}" for name, text in stage) + f" FROM ({source}) s{k}"
    return source
