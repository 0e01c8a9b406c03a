"""BLAKE2b of eight bytes as Column expressions: no Python in the plan.

Longs stand for words of 64 bits. Sums are made of halves, as a sum of longs that overflows is an error. A value that is used more than once
is bound by a transform of an array of one, since an expression has no names of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The initial words, and the order in which rounds take the words of a message.
IV = (
    0x6A09E667F3BCC908, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B, 0xA54FF53A5F1D36F1,
    0x510E527FADE682D1, 0x9B05688C2B3E6C1F, 0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179,
)
SIGMA = (
    (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15),
    (14, 10, 4, 8, 9, 15, 13, 6, 1, 12, 0, 2, 11, 7, 5, 3),
    (11, 8, 12, 0, 5, 2, 15, 13, 10, 14, 3, 6, 7, 1, 9, 4),
    (7, 9, 3, 1, 13, 12, 11, 14, 2, 6, 5, 10, 4, 0, 15, 8),
    (9, 0, 5, 7, 2, 4, 10, 15, 14, 1, 11, 12, 6, 8, 3, 13),
    (2, 12, 6, 10, 0, 11, 8, 3, 4, 13, 7, 5, 15, 14, 1, 9),
    (12, 5, 1, 15, 14, 13, 4, 10, 0, 7, 6, 3, 9, 2, 8, 11),
    (13, 11, 7, 14, 12, 1, 3, 9, 5, 0, 15, 4, 8, 6, 2, 10),
    (6, 15, 14, 9, 11, 3, 0, 8, 12, 2, 13, 7, 1, 4, 10, 5),
    (10, 2, 8, 4, 7, 6, 1, 5, 15, 11, 9, 14, 3, 12, 13, 0),
)
COLUMNS = ((0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15), (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14))
ROUNDS, DIGEST = 12, 8
#: The first word's parameters: the digest's length, no key, one leaf of depth one.
FIRST = IV[0] ^ 0x01010000 ^ DIGEST
_LOW = 0xFFFFFFFF


def steps() -> list[tuple[int, ...]]:
    """(a, b, c, d, x, y) of each mixing step: places of the state, and of the message."""
    return [(*COLUMNS[i], SIGMA[r % 10][2 * i], SIGMA[r % 10][2 * i + 1]) for r in range(ROUNDS) for i in range(8)]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("long")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(*words: Column) -> Column:
    low, high = words[0].bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(words[0], 32)
    for w in words[1:]:
        low, high = low + w.bitwiseAND(F.lit(_LOW)), high + F.shiftrightunsigned(w, 32)
    return F.shiftleft(high + F.shiftrightunsigned(low, 32), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))


def _turned(x: Column, y: Column, n: int) -> Column:
    both = x.bitwiseXOR(y)
    return F.shiftrightunsigned(both, n).bitwiseOR(F.shiftleft(both, 64 - n))


def _mixed(v: Column, m: Column, s: Column) -> Column:
    """The state after one step."""
    at = {k: F.get(v, s[k]) for k in "abcd"}

    def done(a, b, c, d):
        return F.transform(v, lambda x, i: F.when(i == s["a"], a).when(i == s["b"], b).when(i == s["c"], c).when(i == s["d"], d).otherwise(x))

    def half(a, b, c, d, word, first, second, then):
        return _with(_sum(a, b, word), lambda a2: _with(_turned(d, a2, first), lambda d2: _with(_sum(c, d2), lambda c2: _with(_turned(b, c2, second), lambda b2: then(a2, b2, c2, d2)))))

    return half(at["a"], at["b"], at["c"], at["d"], F.get(m, s["x"]), 32, 24, lambda a, b, c, d: half(a, b, c, d, F.get(m, s["y"]), 16, 63, done))


def first_word(text: Column) -> Column:
    """The eight bytes of a text's digest as a long, the first byte lowest; null for null."""
    size = F.octet_length(text)
    blocks = F.greatest(F.lit(1), F.ceil(size / 128)).cast("int")
    digits = F.rpad(F.hex(F.encode(text, "UTF-8")), blocks * 256, F.lit("0"))
    plan = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip("abcdxy", s, strict=True)]) for s in steps()])

    def message(said: Column, block: Column) -> Column:
        byte = lambda i, j: F.substr(said, block * 256 + i * 16 + (15 - 2 * j), F.lit(2))
        return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.concat(*[byte(i, j) for j in range(8)]), 16, -10).cast("long"))

    def compressed(h: Column, said: Column, block: Column, count: Column, length: Column) -> Column:
        last = block == count - 1
        read = F.when(last, length.cast("long")).otherwise((block + 1).cast("long") * 128)
        start = F.concat(h, F.array(*[_signed(x) for x in IV[:4]], _signed(IV[4]).bitwiseXOR(read), _signed(IV[5]), F.when(last, F.bitwise_not(_signed(IV[6]))).otherwise(_signed(IV[6])), _signed(IV[7])))
        mixed = _with(message(said, block), lambda m: F.aggregate(plan, start, lambda v, s: _mixed(v, m, s)))
        return _with(mixed, lambda v: F.transform(h, lambda x, i: x.bitwiseXOR(F.get(v, i)).bitwiseXOR(F.get(v, i + 8))))

    start = F.array(_signed(FIRST), *[_signed(x) for x in IV[1:]])
    made = _with(
        F.struct(digits.alias("said"), blocks.alias("count"), size.alias("length")),
        lambda t: F.aggregate(F.sequence(F.lit(0), t["count"] - 1), start, lambda h, b: compressed(h, t["said"], b, t["count"], t["length"])),
    )
    return F.when(text.isNotNull(), F.get(made, F.lit(0)))


def bucket(text: Column, dim: int) -> Column:
    """The digest, read from its first byte on as a whole number, modulo a dimension below 2^31."""
    byte = lambda w, j: F.shiftrightunsigned(w, 8 * j).bitwiseAND(F.lit(255).cast("long"))
    quarter = lambda w, k: sum((byte(w, k + j) * (1 << 8 * (3 - j)) for j in range(1, 4)), byte(w, k) * (1 << 24))
    return _with(first_word(text), lambda w: (((quarter(w, 0) % dim) * ((1 << 32) % dim) + quarter(w, 4) % dim) % dim).cast("int"))


def bucket_sql(table: str, dim: int) -> str:
    """SQL steps: of the tokens in ``table`` the column bucket, in ``hashed``, worked out on whole numbers beyond 64 bits."""
    two, words = "18446744073709551616::UHUGEINT", ", ".join(f"{x}::UBIGINT" for x in IV)
    low = lambda e: f"(({e}) % {two})::UBIGINT"
    rot = lambda z, n: f"(({z} >> {n}) | {low(f'{z}::UHUGEINT * {1 << (64 - n)}::UHUGEINT')})"
    place = lambda k: f"plan[step + 1][{'abcdxy'.index(k) + 1}]"
    plan = "[" + ", ".join("[" + ", ".join(str(x + 1) for x in s) + "]" for s in steps()) + "]"
    count = len(steps())
    add = lambda *xs: low(" + ".join(f"{x}::UHUGEINT" for x in xs))
    start = f"[{', '.join(f'h[{i + 1}]' for i in range(8))}, {', '.join(f'{x}::UBIGINT' for x in IV[:4])}, xor({IV[4]}::UBIGINT, least(size, (block + 1) * 128)::UBIGINT), {IV[5]}::UBIGINT, CASE WHEN block = blocks - 1 THEN {IV[6] ^ ((1 << 64) - 1)}::UBIGINT ELSE {IV[6]}::UBIGINT END, {IV[7]}::UBIGINT]"
    word = "('0x' || list_aggregate(list_transform(range(8), lambda j: substr(digits, (block * 256 + i * 16 + 15 - 2 * j)::BIGINT, 2)), 'string_agg', ''))::UBIGINT"
    return f"""
sized AS (
  SELECT token, octet_length(encode(token)) AS size, greatest(1, (octet_length(encode(token)) + 127) // 128) AS blocks FROM (SELECT DISTINCT token FROM {table})
), spelt AS (SELECT *, rpad(hex(encode(token)), (blocks * 256)::INTEGER, '0') AS digits FROM sized
), state AS (
  SELECT token, size, blocks, digits, 0 AS block, -1 AS step, [{FIRST}::UBIGINT, {", ".join(words.split(", ")[1:])}] AS h, []::UBIGINT[] AS v, []::UBIGINT[] AS m FROM spelt
  UNION ALL
  SELECT token, size, blocks, digits, CASE WHEN step = {count} THEN block + 1 ELSE block END, CASE WHEN step = {count} THEN -1 ELSE step + 1 END,
         CASE WHEN step = {count} THEN list_transform(range(1, 9), lambda i: xor(xor(h[i], v[i]), v[i + 8])) ELSE h END,
         CASE WHEN step = -1 THEN {start} WHEN step = {count} THEN v ELSE list_transform(range(1, 17), lambda i: CASE i WHEN a THEN a2 WHEN b THEN b2 WHEN c THEN c2 WHEN d THEN d2 ELSE v[i] END) END,
         CASE WHEN step = -1 THEN list_transform(range(16), lambda i: {word}) ELSE m END
  FROM (SELECT *, {rot("t4", 63)} AS b2 FROM (SELECT *, xor(b1, c2) AS t4
  FROM (SELECT *, {add("c1", "d2")} AS c2 FROM (SELECT *, {rot("t3", 16)} AS d2 FROM (SELECT *, xor(d1, a2) AS t3
  FROM (SELECT *, {add("a1", "b1", f"coalesce(m[{place('y')}], 0)")} AS a2 FROM (SELECT *, {rot("t2", 24)} AS b1 FROM (SELECT *, xor(vb, c1) AS t2
  FROM (SELECT *, {add("vc", "d1")} AS c1 FROM (SELECT *, {rot("t1", 32)} AS d1 FROM (SELECT *, xor(vd, a1) AS t1
  FROM (SELECT *, {add("va", "vb", f"coalesce(m[{place('x')}], 0)")} AS a1
  FROM (SELECT *, coalesce(v[a], 0)::UBIGINT AS va, coalesce(v[b], 0)::UBIGINT AS vb, coalesce(v[c], 0)::UBIGINT AS vc, coalesce(v[d], 0)::UBIGINT AS vd
  FROM (SELECT s.*, plan, {", ".join(f"{place(k)} AS {k}" for k in "abcd")} FROM state s, (SELECT {plan} AS plan) WHERE block < blocks))))))))))))))
), hashed AS (
  SELECT token, (list_reduce(list_transform(range(8), lambda j: ((h[1] >> (8 * j)) & 255)::UHUGEINT), lambda x, y: x * 256 + y) % {dim})::INTEGER AS bucket FROM state WHERE block = blocks
)"""
