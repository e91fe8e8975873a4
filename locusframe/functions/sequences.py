"""Column functions on nucleotide and protein text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.shared import stored

#: IUPAC letters and their complements.
IUPAC, COMPLEMENT = "ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"
_PAIRED = str.maketrans(IUPAC, COMPLEMENT)
#: Fixed value: the universal code, codons in TCAG order.
UNIVERSAL = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Codons in which other codes differ from the universal one.
CODES = {
    "universal": {},
    "Euplotes": {"TGA": "C"},
    "Tetrahymena": {"TAA": "Q", "TAG": "Q"},
    "Acetabularia": {"TAA": "Q", "TAG": "Q"},
    "Candida": {"CTG": "S"},
    "mitochondrial": {"TGA": "W", "ATA": "M", "AGA": "*", "AGG": "*"},
}
#: Splice site pairs by code.
SPLICE = {"+": [("GT", "AG"), ("AT", "AC")], "-": [("CT", "AC"), ("GT", "AT")]}


def complement(seq: Column) -> Column:
    return F.translate(seq, IUPAC, COMPLEMENT)


def reverse_complement(seq: Column) -> Column:
    """IUPAC letters, case kept."""
    return F.reverse(complement(seq))


def codon_table(code: str = "universal") -> dict[str, str]:
    table = {"".join(c): a for c, a in zip(product("TCAG", repeat=3), UNIVERSAL, strict=True)}
    return table | CODES[code]


def _residues(code: str) -> np.ndarray:
    """Amino acids (as bytes) by codon number: first * 25 + second * 5 + third of T, C, A, G and other letters."""
    out = np.full(125, ord("X"), np.uint8)
    for codon, residue in codon_table(code).items():
        a, b, c = ("TCAG".index(x) for x in codon)
        out[a * 25 + b * 5 + c] = ord(residue)
    return out


#: The number of each letter: T and U 0, C 1, A 2, G 3, all others 4.
_NUMBER = np.full(256, 4, np.int16)
for _letters, _n in (("TtUu", 0), ("Cc", 1), ("Aa", 2), ("Gg", 3)):
    _NUMBER[[ord(x) for x in _letters]] = _n


def _translated(seq: str, offset: int, residues: np.ndarray) -> np.ndarray:
    """The residues of the whole codons behind an offset."""
    x = _NUMBER[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)[offset:]]
    n = len(x) // 3
    x = x[:3 * n].reshape(n, 3)
    return residues[x[:, 0] * 25 + x[:, 1] * 5 + x[:, 2]]


def codon_numbers(text: str) -> np.ndarray:
    """The number of the codon that begins at each letter but the last two."""
    x = _NUMBER[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    return x[:-2] * 25 + x[1:-1] * 5 + x[2:]


def residues_by_number(code: str = "universal") -> np.ndarray:
    """Amino acids (as bytes) by codon number; codons with unknown letters are X."""
    return _residues(code)


def reversed_residues(code: str = "universal") -> np.ndarray:
    """The same for codons read on the other strand."""
    a, b, c = np.unravel_index(np.arange(125), (5, 5, 5))
    other = np.array([2, 3, 0, 1, 4])  # T and A, C and G
    return _residues(code)[other[c] * 25 + other[b] * 5 + other[a]]


def translate(seq: Column, offset: int | Column = 0, code: str = "universal") -> Column:
    """Amino acids from an offset; U reads as T, codons with other letters are X. Null stays null."""
    residues = _residues(code)

    @F.pandas_udf("string")
    def run(seqs: pd.Series, offsets: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else _translated(s, o, residues).tobytes().decode() for s, o in zip(seqs, offsets, strict=True)], dtype=object)

    return run(seq, F.lit(offset) if isinstance(offset, int) else offset)


def splice_code(donor: Column, acceptor: Column) -> Column:
    """X11: + or - for known splice site pairs, else 0."""
    d, a, out = F.upper(donor), F.upper(acceptor), None
    for code, pairs in SPLICE.items():
        for x, y in pairs:
            test = (d == x) & (a == y)
            out = F.when(test, code) if out is None else out.when(test, code)
    return F.when(donor.isNull() | acceptor.isNull(), None).otherwise(out.otherwise("0"))


def longest_orf(seq: Column, code: str = "universal", start: str = "", with_stop: bool = False, both_strands: bool = False) -> Column:
    """The longest run of residues without a stop, as struct<peptide, offset, strand>; ties go to the first.

    start: only runs from this residue on count (M). with_stop: a stop that closes the run is added. both_strands:
    the reverse complement is looked through as well, with offsets on it and the plus strand first among equals. A
    sequence without any run has an empty peptide, null stays null."""
    residues = _residues(code)

    def best(text: str) -> tuple[int, int, str]:
        found = (0, 0, "")
        for frame in range(3):
            p = _translated(text, frame, residues)
            stops = np.flatnonzero(p == ord("*"))
            begin, end = np.concatenate([[0], stops + 1]), np.concatenate([stops, [len(p)]])
            if start:
                at = np.concatenate([np.flatnonzero(p == ord(start)), [len(p)]])
                begin = at[np.searchsorted(at, begin)]
            n = end - begin
            k = int(n.argmax())
            # the longest, then the smallest offset
            if n[k] > 0 and (-n[k], begin[k] * 3 + frame) < (-found[0], found[1] if found[0] else 0):
                found = (int(n[k]), int(begin[k]) * 3 + frame, p[begin[k]:end[k]].tobytes().decode() + "*" * bool(with_stop and end[k] < len(p)))
        return found

    @F.pandas_udf("peptide string, offset int, strand int")
    def run(seqs: pd.Series) -> pd.DataFrame:
        rows = []
        for s in seqs:
            if s is None:
                rows.append((None, None, None))
                continue
            plus = best(s)
            minus = best(s.translate(_PAIRED)[::-1]) if both_strands else plus
            rows.append((minus[2], minus[1], -1) if minus[0] > plus[0] else (plus[2], plus[1], 1))
        return pd.DataFrame(rows, columns=["peptide", "offset", "strand"]).astype({"offset": "Int32", "strand": "Int32"})

    return run(seq)


def records(rows: DataFrame, text: str) -> DataFrame:
    """FASTA records without their mark as seqid, definition and seq; line ends and blanks within sequences go."""
    head = F.regexp_extract(text, r"^([^\n]*)", 1)
    return rows.select(F.regexp_extract(head, r"^(\S+)", 1).alias("seqid"), F.regexp_extract(head, r"^\S+\s+(.*?)\s*$", 1).alias("definition"), F.regexp_replace(F.regexp_replace(text, r"^[^\n]*\n?", ""), r"\s+", "").alias("seq"))


def wrapped(seq: Column, width: int = 60) -> Column:
    """Lines of `width` letters."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def tiles(seqs: DataFrame, size: int, step: int, as_written: bool = True) -> DataFrame:
    """Seqid, s, e and tile. As written: text one letter late, and no tile in the last place."""
    stop = F.length("seq") - size - (1 if as_written else 0)
    shift = 2 if as_written else 1
    # tiles are cut before rows are made, so that no row carries the whole text
    cut = F.transform(F.sequence(F.lit(0), stop, F.lit(step)), lambda o: F.struct((o + 1).alias("s"), (o + size).alias("e"), F.substring("seq", o + shift, F.lit(size)).alias("tile")))
    return seqs.where(stop >= 0).select("seqid", F.explode(cut).alias("t")).select("seqid", "t.*")


def broken(seqs: DataFrame, size: int) -> DataFrame:
    """Consecutive pieces; the last may be shorter."""
    return seqs.where(F.length("seq") > 0).select("seqid", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(.{{1,{size}}})"), 1)).alias("piece", "part"))


def masked(seqs: DataFrame, pieces: DataFrame, hard: bool = True, pad: int = 0) -> DataFrame:
    """Sequences with the pieces as N (hard) or lower case; each text is cut once and its parts are joined, row by row, so that no batch of texts is held."""
    low, high = (F.col("s") - pad).cast("long"), (F.col("e") + pad).cast("long")
    spans = pieces.groupBy("seqid").agg(F.array_sort(F.collect_list(F.struct(low.alias("s"), high.alias("e")))).alias("_p"))
    both = seqs.join(spans, "seqid", "left")
    n = F.length("seq").cast("long")
    inside = F.filter("_p", lambda x: x["s"] <= n)
    part = lambda b, e: F.substring("seq", (b + 1).cast("int"), (e - b).cast("int"))

    def step(done: Column, x: Column) -> Column:
        b, e = F.greatest(x["s"] - 1, done["at"]), F.least(x["e"], n)
        cut = F.repeat(F.lit("N"), (e - b).cast("int")) if hard else F.lower(part(b, e))
        return F.when(e > b, F.struct(e.alias("at"), F.concat(done["parts"], F.array(part(done["at"], b), cut)).alias("parts"))).otherwise(done)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = lambda done: F.concat(F.array_join(done["parts"], ""), part(done["at"], n))
    return both.withColumn("seq", F.coalesce(F.aggregate(inside, start, step, rest), "seq")).drop("_p")


def n50(seqs: DataFrame, keys: list[str], as_written: bool = True) -> DataFrame:
    """The length at which half of all letters is reached, longest first.

    As written: if the half is passed and not met, the mean with the length before, rounded half up
    (0 before the first). Lengths are counted first, so a group's windows see distinct lengths only."""
    lengths = seqs.groupBy(*keys, F.length("seq").alias("n")).agg(F.count("*").alias("times"))
    order = Window.partitionBy(*keys).orderBy(F.desc("n"))
    whole = Window.partitionBy(*keys)
    rows = lengths.withColumn("_sum", F.sum(F.col("n") * F.col("times")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_total", F.sum(F.col("n") * F.col("times")).over(whole)).withColumn("_previous", F.coalesce(F.lag("n").over(order), F.lit(0)))
    hit = rows.where("2 * _sum >= _total and 2 * (_sum - n * times) < _total")
    if not as_written:
        return hit.select(*keys, F.col("n").alias("n50"))
    # how many of this length it takes, and what stands before the one that reaches the half
    need = F.col("_total") / 2 - (F.col("_sum") - F.col("n") * F.col("times"))
    k = F.ceil(need / F.col("n"))
    exact = need == k * F.col("n")
    before = F.when(k > 1, F.col("n")).otherwise(F.col("_previous"))
    return hit.select(*keys, F.when(exact, F.col("n")).otherwise(F.floor((F.col("n") + before) / 2 + 0.5)).cast("int").alias("n50"))


def _letters(text: str) -> np.ndarray:
    """A number for each letter, spread over 64 bits."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _doubled(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The numbers of windows from those of their halves."""
    x = left * np.uint64(0x94D049BB133111EB) + (right ^ (right >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _ends(text: str) -> np.ndarray:
    """The numbers of a text's first and last 2^k letters, as many as it has."""
    size = 1 << (len(text).bit_length() - 1)
    x = _letters(text[:size] + text[-size:]).reshape(2, size)
    while x.shape[1] > 1:
        x = _doubled(x[:, ::2], x[:, 1::2])
    return x[:, 0]


#: Letters that are worked on at a time, so that a long text takes 8 bytes a letter and not several times as much.
_AT_A_TIME = 1 << 16


def _windows(texts: list[str], largest: int) -> Iterator[tuple[int, np.ndarray]]:
    """k and the numbers of all windows of 2^k letters, up to `largest`, of texts put one behind the other, longest first; texts that have no such window
    are left out. Each array takes the place of the one before. Numbers of windows that reach into the next text are of no use."""
    n = np.array([len(s) for s in texts])
    x, at = np.empty(int(n.sum()), np.uint64), 0
    for s in texts:
        for i in range(0, len(s), _AT_A_TIME):
            part = _letters(s[i:i + _AT_A_TIME])
            x[at:at + len(part)] = part
            at += len(part)
    for k in range(min(largest + 1, len(texts[0]).bit_length())):
        m = int(n[n >= 1 << k].sum()) - (1 << k) + 1
        if k:
            half = 1 << (k - 1)
            for i in range(0, m, _AT_A_TIME):  # nothing is read that was written before
                j = min(i + _AT_A_TIME, m)
                x[i:j] = _doubled(x[i:j], x[i + half:j + half])
        x = x[:m]
        yield k, x


def _both(head: np.ndarray, tail: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A number for sequences of n letters that begin and end with windows of these numbers."""
    return _doubled(_doubled(head, tail), n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Fixed value: the largest filter has 2^22 words of 64 bits.
_MOST_WORDS = 22


def _filter_of(rows: DataFrame, n: int, *names: str) -> np.ndarray:
    """A Bloom filter of the numbers in these columns of n rows, as bytes: 64 bits for each number but 32 MB at most. A number's first bits tell the byte, its
    last three the bit; so do those of its halves exchanged. It only keeps out most of what can't match."""
    bits = min(_MOST_WORDS, max(10, (n * len(names)).bit_length()))
    numbers = rows.select(F.explode(F.array(*names)).alias("x"))
    both = F.array("x", F.shiftleft("x", 32).bitwiseOR(F.shiftrightunsigned("x", 32)))
    words = numbers.select(F.explode(both).alias("h")).select(F.shiftrightunsigned("h", 64 - bits).alias("w"), F.expr(f"shiftleft(1L, cast(8 * (shiftrightunsigned(h, {61 - bits}) & 7) + (h & 7) as int))").alias("b"))
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << bits, "<u8")
    out[found["w"].to_numpy()] = found["b"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def _passes(filled: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where numbers are in the filter."""
    shift = np.uint64(65 - len(filled).bit_length())

    def held(h: np.ndarray) -> np.ndarray:
        return (np.take(filled, (h >> shift).view(np.int64)) >> (h.astype(np.uint8) & np.uint8(7)) & np.uint8(1)).view(bool)

    found = []
    for i in range(0, len(x), _AT_A_TIME):
        at = np.flatnonzero(held(x[i:i + _AT_A_TIME])) + i
        y = x[at]
        found.append(at[held((y << np.uint64(32)) | (y >> np.uint64(32)))])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _first_of(x: np.ndarray, heads: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    """Which of the places where heads lie (their texts end at `end`) are left, if of those followed by the same letters, as far as a sequence of
    under 2^(k+1) letters reaches, one does. Without it a text of one letter would have a pair for each two places."""
    size = 1 << k
    whole = heads + 2 * size <= end
    inner, ends = np.flatnonzero(whole), np.flatnonzero(~whole)
    at = heads[inner]
    kept = inner[np.unique(_doubled(x[at], x[at + size - 1]), return_index=True)[1]]
    if len(ends) > 1:  # what is left of the text there, beside the same letters at the last place before that has this head
        order = ends[np.argsort(x[heads[ends]], kind="stable")]
        here, before, stop = heads[order[1:]], heads[order[:-1]], end[order[1:]]
        again = (x[here] == x[before]) & (end[order[:-1]] == stop)
        again &= x[np.minimum(before + stop - here, stop) - size] == x[stop - size]
        ends = np.concatenate([order[:1], order[1:][~again]])
    return np.sort(np.concatenate([kept, ends]))


#: Pairs of places that are looked at together.
_PAIRS = 1 << 18


def _inside(texts: list[str], sizes: set[int], near: np.ndarray, exact: np.ndarray) -> Iterator[str]:
    """What lies in texts and passes the filters of heads and tails (near) and of whole sequences (exact), but no whole text; equal parts mostly once."""
    texts = sorted((s for s in texts if s), key=len, reverse=True)
    if not texts or not sizes:
        return
    length = np.array([len(s) for s in texts])
    begin = np.cumsum(length) - length
    for k, x in _windows(texts, max(sizes)):
        found = _passes(near, x) if k in sizes else ()
        if not len(found):
            continue
        size = 1 << k
        owner = np.searchsorted(begin, found, "right") - 1
        valid = found + size <= begin[owner] + length[owner]
        tails, owner = found[valid], owner[valid]
        first = _first_of(x, tails, begin[owner] + length[owner], k)
        heads, owner = tails[first], owner[first]
        low, high = np.searchsorted(tails, heads), np.searchsorted(tails, np.minimum(heads + size, begin[owner] + length[owner]))
        upto = np.concatenate([[0], np.cumsum(high - low)])
        seen, at = np.zeros(0, np.uint64), 0
        while at < len(heads):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + _PAIRS, "right")) - 1)
            which = np.repeat(np.arange(at, to), (high - low)[at:to])
            last = tails[np.arange(upto[at], upto[to]) - upto[which] + low[which]]
            n = last - heads[which] + size
            ok = n < length[owner[which]]
            which, last, n = which[ok], last[ok], n[ok]
            number = _both(x[heads[which]], x[last], n)
            passed = _passes(exact, number)
            number, i = np.unique(number[passed], return_index=True)
            new = ~np.isin(number, seen)
            for j in passed[i[new]].tolist():
                o = owner[which[j]]
                b = int(heads[which[j]] - begin[o])
                yield texts[o][b:b + int(n[j])]
            seen, at = np.concatenate([seen, number[new]]), to


def _grouped(texts: Iterator[str]) -> Iterator[list[str]]:
    """Texts in groups of a few blocks of letters, or one longer text."""
    group, letters = [], 0
    for s in texts:
        if group and letters + len(s) > 4 * _AT_A_TIME:
            yield group
            group, letters = [], 0
        group.append(s)
        letters += len(s)
    yield group


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def not_contained(seqs: DataFrame) -> DataFrame:
    """seqid of the distinct sequences (the smallest seqid of each) that no longer one contains.

    A sequence of n letters is all in its head and its tail, the first and the last 2^k letters with 2^k <= n < 2^(k+1). Windows of those sizes are numbered
    in every sequence (each size from the one before); what passes a filter of all heads and tails is put together to pairs, and pairs that pass a
    filter of what heads, tails and lengths occur together are cut out and met by digest. So a sequence yields rows for what it contains alone, however many
    others begin as it does; no texts are shuffled behind the first step, and few letters of a batch are worked on together."""
    u = seqs.where("seq is not null").groupBy("seq").agg(F.min("seqid").alias("seqid"))
    u = stored(u.select("seqid", "seq"))
    kind = u.schema["seqid"].dataType.simpleString()

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            n, head, tail, digest = np.zeros(m, np.int64), np.zeros(m, np.uint64), np.zeros(m, np.uint64), [b""] * m
            for i, x in enumerate(b["seq"]):
                s = x.as_py()
                n[i], (head[i], tail[i]), digest[i] = len(s), _ends(s), _digest(s)
            columns = [b["seqid"], pa.array(n), *(pa.array(x.view(np.int64)) for x in (head, tail, _both(head, tail, n))), pa.array(digest, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["seqid", "n", "head", "tail", "both", "digest"])

    own = stored(u.where("seq <> ''").mapInArrow(numbers, f"seqid {kind}, n long, head long, tail long, both long, digest binary"))
    context = u.sparkSession.sparkContext
    m = own.count()
    near, exact = context.broadcast(_filter_of(own, m, "head", "tail")), context.broadcast(_filter_of(own, m, "both"))
    sizes = {r[0] for r in own.select(F.expr("length(bin(n)) - 1")).distinct().collect()}

    def contained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n", "digest"]

        def out(found: set[tuple[int, bytes]]) -> pa.RecordBatch:
            n, digest = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(digest, pa.binary())], names)

        found: set[tuple[int, bytes]] = set()
        for texts in _grouped(x.as_py() for b in batches for x in b["seq"]):
            for part in _inside(texts, sizes, near.value, exact.value):
                found.add((len(part), _digest(part)))
                if len(found) == 10_000:
                    yield out(found)
                    found = set()
        yield out(found)

    inside = u.where("seq <> ''").select("seq").mapInArrow(contained, "n long, digest binary").distinct()
    # the empty sequence lies in every other one
    empty = u.where("seq = ''").select("seqid").join(own.limit(1).select(F.lit(1).alias("_any")), how="left_anti")
    return own.join(inside, ["n", "digest"], "left_anti").select("seqid").union(empty)
