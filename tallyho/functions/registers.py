"""Register-frame column expressions (M2-M9, F13), all JVM-side.

Frames are ``BinaryType``.  Byte-level work uses higher-order functions over an
``array<int>`` of the frame's bytes (no Python UDF): CRC-16 is a nested ``aggregate``,
register words are a ``transform`` over their indices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(arr, i) -> Column:
    """1-based array element, null when out of range (ANSI-safe)."""
    return F.try_element_at(arr, (i if isinstance(i, Column) else F.lit(i)).cast("int"))


def byte_array(frame) -> Column:
    """Unsigned bytes of a binary column as ``array<int>`` (empty for an empty frame)."""
    # hex once per frame, cut into two-character pairs, each pair read as a number
    pairs = F.regexp_extract_all(F.hex(_col(frame)), F.lit("[0-9A-F]{2}"), F.lit(0))
    return F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int"))


def _crc_table(poly: int) -> list[int]:
    """CRC of every single byte value under the reflected polynomial (256 entries, derived
    from the polynomial, so the per-byte update needs one lookup instead of 8 shifts)."""
    table = []
    for value in range(256):
        c = value
        for _ in range(8):
            c = (c >> 1) ^ poly if c & 1 else c >> 1
        table.append(c)
    return table


_CRC_TABLE = _crc_table(config.CRC_POLY_REFLECTED)


def crc16(bytes_arr) -> Column:
    """M2: CRC-16 (initial 0xFFFF, reflected polynomial 0xA001) of an ``array<int>``,
    table-driven: ``crc = (crc >> 8) ^ table[(crc ^ byte) & 0xFF]`` per byte."""
    table = F.array(*[F.lit(v) for v in _CRC_TABLE])

    def step(crc, b):
        idx = crc.bitwiseXOR(b).bitwiseAND(F.lit(0xFF)) + 1
        return F.shiftright(crc, 8).bitwiseXOR(F.element_at(table, idx))
    return F.aggregate(_col(bytes_arr), F.lit(config.CRC_INIT), step)


def with_crc(body) -> Column:
    """Frame body followed by its CRC, low byte first (as sent on the wire)."""
    crc = crc16(byte_array(body))
    tail = F.concat(F.lpad(F.hex(crc.bitwiseAND(F.lit(0xFF))), 2, "0"),
                    F.lpad(F.hex(F.shiftright(crc, 8)), 2, "0"))
    return F.concat(_col(body), F.unhex(tail))


def crc_ok(frame) -> Column:
    """M8: the CRC of all but the last two bytes equals the little-endian tail.

    Checked in one pass: for this CRC (reflected, no final XOR) the CRC over the body
    followed by its CRC, low byte first, is zero exactly when the tail matches."""
    return F.when(F.octet_length(_col(frame)) >= 3, crc16(byte_array(frame)) == 0).otherwise(F.lit(False))


def crc_ok_bytes(bytes_arr) -> Column:
    """M8 on a frame already split into bytes."""
    arr = _col(bytes_arr)
    return F.when(F.size(arr) >= 3, crc16(arr) == 0).otherwise(F.lit(False))


def read_request(address, function, start, count) -> Column:
    """M3: 8-byte read request -- address, function, start hi/lo, count hi/lo, CRC lo/hi."""
    def hex2(c):
        return F.lpad(F.hex(_col(c).cast("long")), 2, "0")
    body = F.unhex(F.concat(hex2(address), hex2(function),
                            F.lpad(F.hex(_col(start).cast("long")), 4, "0"),
                            F.lpad(F.hex(_col(count).cast("long")), 4, "0")))
    return with_crc(body)


def reply_registers(bytes_arr) -> Column:
    """M4: big-endian u16 registers after the byte-count byte (``count div 2`` of them)."""
    arr = _col(bytes_arr)
    cnt = at(arr, 3)
    last = (F.floor(cnt / 2) - 1).cast("int")
    words = F.transform(F.sequence(F.lit(0), last),
                        lambda i: at(arr, i * 2 + 4) * 256 + at(arr, i * 2 + 5))
    return F.when(cnt >= 2, words).otherwise(F.array().cast("array<int>"))


def is_exception(function) -> Column:
    """M9: an exception reply has the high bit of the function code set."""
    return _col(function).bitwiseAND(F.lit(0x80)) > 0


def scaled_int(value) -> Column:
    """M5: register / 10 with integer division (the C code's printout)."""
    return F.floor(_col(value) / 10).cast("int")


def scaled(value) -> Column:
    """M5: register / 10 as a decimal number."""
    return _col(value) / 10.0


def float_from_words(hi, lo) -> Column:
    """M6: IEEE-754 float32 from two 16-bit words, ``hi`` holding sign/exponent bits.

    The original reads words swapped (``pack('>HH', regs[1], regs[0])``), so pass
    ``hi = regs[1], lo = regs[0]``.  NaN and infinities come out as such.
    """
    bits = _col(hi).cast("long") * 65536 + _col(lo).cast("long")
    sign = F.when(F.shiftright(bits, 31).bitwiseAND(F.lit(1)) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exp = F.shiftright(bits, 23).bitwiseAND(F.lit(0xFF))
    mant = bits.bitwiseAND(F.lit(0x7FFFFF)).cast("double")
    normal = (F.lit(1.0) + mant / 8388608.0) * F.pow(F.lit(2.0), exp - 127)
    subnormal = mant * F.pow(F.lit(2.0), F.lit(-149))
    special = F.when(mant == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return sign * F.when(exp == 255, special).when(exp == 0, subnormal).otherwise(normal)


def logical_address(base, start) -> Column:
    """M7: '3x' -> 30001 + start, '4x' -> 40001 + start."""
    first = F.when(_col(base) == "3x", F.lit(config.REGISTER_BASE_INPUT)).otherwise(F.lit(config.REGISTER_BASE_HOLDING))
    return first + _col(start)


def hex_word(value) -> Column:
    """lower-case hex of a register (printf "%x")."""
    return F.lower(F.hex(_col(value).cast("long")))


def decimal_dump(bytes_arr) -> Column:
    """bytes printed as signed decimals separated by spaces (C ``char`` printf)."""
    return F.array_join(F.transform(_col(bytes_arr), lambda b: F.when(b > 127, b - 256).otherwise(b).cast("string")), " ")


# ---- F14: text / number conversions of the byte helpers (built-ins) -----------------
def hex_text(bytes_col) -> Column:
    """bytes as upper-case hex text."""
    return F.hex(_col(bytes_col))


def bytes_from_decimal_text(text) -> Column:
    """'1 3 0 1' (decimal byte values separated by spaces) -> binary."""
    parts = F.split(F.trim(_col(text)), " +")
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.lpad(F.hex(p.cast("int")), 2, "0")), ""))


def octal_to_decimal(text) -> Column:
    """octal text -> decimal number."""
    return F.conv(_col(text), 8, 10).cast("long")
