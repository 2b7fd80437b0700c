"""Order-free identity of a listing (incremental multiset hash).

Each entry contributes two 60-bit lanes taken from md5 of ``path|checksum``;
a listing's lanes are sums modulo 2^60 (Clarke et al., *Incremental Multiset
Hash Functions*, 2003).  Sums merge map-side, so a listing of any size is one
partial+final aggregate, and a new listing's identity is the old one plus the
added entries' lanes minus the removed ones' -- only changed paths are read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed lane parameters.
MODULUS = 1 << 60
LANE_SLICES = ((1, 15), (16, 15))   # (start, length) of hex slices of md5
DEC = "decimal(38,0)"


def entry_key(path: Column, checksum: Column) -> Column:
    return F.concat_ws("|", path, checksum)


def packed(text: Column | str) -> list[Column]:
    """A text as it is moved: ``hex_bytes`` if it is lower-case hex, as most checksums are
    (half the bytes), else ``other``.  ``unpacked`` gives it back."""
    c = F.col(text) if isinstance(text, str) else text
    is_hex = c.rlike("^(?:[0-9a-f]{2})+\\z")
    return [F.when(is_hex, F.unhex(c)).alias("hex_bytes"), F.when(~is_hex, c).alias("other")]


def unpacked(hex_bytes: Column, other: Column) -> Column:
    return F.coalesce(F.lower(F.hex(hex_bytes)), other)


def lane(key: Column, i: int) -> Column:
    start, length = LANE_SLICES[i]
    return F.conv(F.substring(F.md5(key), start, length), 16, 10).cast(DEC)


def lanes(path: Column, checksum: Column, sign: Column | int = 1) -> list[Column]:
    k = entry_key(path, checksum)
    s = F.lit(sign) if isinstance(sign, int) else sign
    return [lane(k, i) * s.cast(DEC) for i in range(len(LANE_SLICES))]


def mod_lane(c: Column) -> Column:
    return F.pmod(c.cast(DEC), F.lit(MODULUS).cast(DEC)).cast(DEC)


def listing_id(l0: Column, l1: Column, n: Column) -> Column:
    """Listing identity from lane sums and entry count."""
    return F.sha2(F.concat_ws("|", mod_lane(l0).cast("string"), mod_lane(l1).cast("string"),
                              n.cast("long").cast("string")), 256)


def commit_id(repository: Column, parents_text: Column, meta_range_id: Column,
              committer: Column, message: Column, epoch_seconds: Column,
              metadata_text: Column) -> Column:
    """Content-derived commit id (see SURVEY §2.6)."""
    return F.sha2(F.concat_ws("|", repository, parents_text, meta_range_id, committer,
                              message, epoch_seconds.cast("long").cast("string"),
                              metadata_text), 256)
