"""Genes against brute force: frames across chunk borders, gaps, competing strands, junctions, consensus of evidence."""

import random

import pytest
from pyspark.sql import functions as F

from locusframe.functions.sequences import codon_table
from locusframe.operators import codons, competition, consensus, frames, junctions

TABLE = codon_table()
PAIR = str.maketrans("ACGTN", "TGCAN")
K = ["tx", "seqid", "strand"]


def protein(seq):
    return "".join(TABLE.get(seq[i:i + 3], "X") for i in range(0, len(seq) - 2, 3))


def reads_through(seq, b, e, strand):
    piece = seq[b - 1:e]
    if len(piece) < e - b + 1:
        return False
    piece = piece if strand > 0 else piece.translate(PAIR)[::-1]
    for f in range(3):
        p = protein(piece[f:])
        if "*" not in p:
            return "X" * 10 not in p
    return False


def contig(seed, n):
    r = random.Random(seed)
    # few stops, so that frames stay open for long; stretches of N
    out = "".join(r.choice(["ACG", "CCC", "GGT", "GCA", "CTG", "TTA" if r.random() < 0.1 else "GGC", "TGA" if r.random() < 0.1 else "CAC"]) for _ in range(n // 3))
    at = n // 2
    return out[:at] + "N" * 45 + out[at + 45:]


@pytest.mark.parametrize("size", [97, 1000])
def test_inferred_exons(spark, size):
    seqs = {1: contig(1, 3000), 2: contig(2, 1500), 3: "ACG"}
    r = random.Random(5)
    reads = []
    for seqid in (1, 2, 3, 4):
        for strand in (1, -1):
            for hit in range(30):
                s = r.randrange(1, 2500)
                for _ in range(r.randrange(1, 4)):
                    e = s + r.randrange(20, 80)
                    reads.append((7, seqid, strand, hit, s, e))
                    s = e + r.randrange(10, 60)
    reads.append((7, 1, 1, 99, 5, 60))  # one block only
    frame = spark.createDataFrame(reads, "tx long, seqid long, strand int, hit long, s long, e long").repartition(3)
    chunks = frames.chunked(spark.createDataFrame(list(seqs.items()), "seqid long, seq string"), size)
    got = {(x.seqid, x.strand, x.s): x.e for x in frames.inferred_exons(frame, K, chunks, size, shortest=60).collect()}
    hits = {}
    for _, seqid, strand, hit, s, e in reads:
        hits.setdefault((seqid, strand, hit), []).append((s, e))
    spliced = [(seqid, strand, sorted(b)) for (seqid, strand, _), b in hits.items() if len(b) > 1]
    want = {}
    for seqid, strand, a in spliced:
        for other, way, b in spliced:
            if (other, way) == (seqid, strand) and b[0][0] > a[-1][1]:
                begin, end = a[-1][0], b[0][1]
                if end - begin >= 60 and reads_through(seqs.get(seqid, ""), begin, end, strand):
                    want[seqid, strand, begin] = max(end, want.get((seqid, strand, begin), 0))
    assert len(want) > 10 and {k[1] for k in want} == {1, -1}
    assert got == want


def test_long_open_frame_over_many_chunks(spark):
    seq = "ATG" + "GCC" * 4000 + "TAA" + "CCC" * 10
    chunks = frames.chunked(spark.createDataFrame([(1, seq)], "seqid long, seq string"), 500)
    points = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, -1, 1), (1, 1, 12_010)], "seqid long, strand int, b long")
    got = {(x.strand, x.b): (x.stops, x.runs) for x in frames.next_marks(chunks, points, 500).collect()}
    assert got[1, 1][0] == [None, 12_004, None] and got[1, 2][0] == [None, 12_004, None]
    assert got[1, 12_010][0] == [None] * 3 and got[-1, 1][1] == [None] * 3
    empty = frames.chunked(spark.createDataFrame([(1, ""), (2, None)], "seqid long, seq string"), 500)
    assert empty.count() == 0 and frames.next_marks(empty, points, 500).count() == 0


def test_gaps_of_proteins(spark):
    rows = [(1, 1, 101, 160, "M4D2M6F1M3R2M5"), (2, -1, 101, 160, "M4D2M6F1M3R2M5"), (3, 1, 101, 160, None), (4, 1, 101, 160, "M40"), (5, -1, 10, 14, ""), (6, 1, 10, 40, "M2I3M2"), (7, 1, 5, 6, None)]
    got = {}
    for x in frames.phased(spark.createDataFrame(rows, "id long, strand int, s long, e long, gap string")).collect():
        got.setdefault(x.id, set()).update((b, (b - x.p) % 3 if x.strand > 0 else 2 - (b - x.p) % 3) for b in range(x.s, x.e + 1))
    want = {}
    for i, strand, s, e, gap in rows:
        whole = (e - s + 1) // 3
        ops = [("M", whole)] if not gap else [(t[0], int(t[1:])) for t in __import__("re").findall(r"[A-Z]\d+", gap)]
        if len(ops) == 1:
            ops = [("M", min(ops[0][1], whole))]
        at = s
        for k, (kind, n) in enumerate(ops):
            if kind == "F":
                at += n
            elif kind == "D":
                at += 3 * n
            elif kind == "M":
                near = k - 1 if strand > 0 else k + 1
                at -= ops[near][1] if 0 <= near < len(ops) and ops[near][0] == "R" else 0
                for c in range(3 * n):
                    if s <= at + c <= e:
                        want.setdefault(i, set()).add((at + c, c % 3 if strand > 0 else 2 - c % 3))
                at += 3 * n
    assert got == want


def test_junctions(spark):
    """A prediction that begins before the limit its neighbour has set is dropped; limits run through many chunks."""
    r = random.Random(11)
    size, flank, chunks, rows = 50, 60, [], []
    for seqid, n in ((1, 40), (2, 1), (3, 7)):
        for k in range(n):
            chunks.append((seqid, k, k * size + 1, (k + 1) * size, k == n - 1))
            for source in ("a", "b"):
                for _ in range(r.randrange(0, 8) if source == "a" else 1):
                    s = r.randrange(max(1, k * size + 1 - flank), (k + 1) * size + flank)
                    rows.append((seqid, source, k, s, s + r.randrange(1, 95 if source == "a" else 140), f"p{len(rows)}"))
        # as long as chunks, each in the next one's way
        rows += [(seqid, "c", k, k * size + 1 + 3 * (k % 2), (k + 1) * size + 2 * (k % 3), f"c{seqid}-{k}") for k in range(n)]
    rows += [(1, "a", 3, 160, 210, "same1"), (1, "a", 3, 160, 210, "same2")]
    want = set()
    for seqid in (1, 2, 3):
        for source in ("a", "b", "c"):
            limit = 0
            for _, k, _, end, last in sorted(c for c in chunks if c[0] == seqid):
                left = sorted((s, e, i) for q, src, c, s, e, i in rows if (q, src, c) == (seqid, source, k) and s >= limit)
                limit = end + 1
                for s, e, i in left:
                    if last or e < end + 1:
                        want.add(i)
                        continue
                    if s < end + 1:
                        want.add(i)
                        limit = e + 1
                    break
    frame = spark.createDataFrame(rows, "seqid long, source string, chunk int, s long, e long, id string").repartition(3)
    bounds = spark.createDataFrame(chunks, "seqid long, chunk int, s long, e long, is_last boolean")
    got = junctions.resolved(frame, bounds, ["seqid", "source"], "id").collect()
    assert len(got) == len({x.id for x in got}) and {x.id for x in got} == want
    assert junctions.resolved(frame.where("false"), bounds, ["seqid", "source"], "id").count() == 0


def test_junctions_of_features(spark):
    """Against all chunks' predictions gone through one after the other; short contigs by one shuffle of the features, long ones by rounds, ids made behind the shuffle."""
    r = random.Random(12)
    size, flank = 45, 40
    rows = [(c, src, k, s, s + r.randrange(60)) for c, longest in ((1, 3000), (2, 300), (3, 66), (4, 20)) for k, src, s in ((k, r.choice("ab"), r.randrange(1, longest)) for k in range(min(250, longest)))]
    rows += [(1, "c", k, 45 * k + 30 + 2 * (k % 3), 45 * k + 85) for k in range(60)] + [(2, "a", 900 + k, 100, 140) for k in range(2)]
    want = set()
    for contig in (1, 2, 3, 4):
        length = max(x[4] for x in rows if x[0] == contig)
        n = max(1, length // size + (length % size * 2 >= size))
        for source in "abc":
            start = 0
            for c in range(n):
                end = length if c == n - 1 else (c + 1) * size
                low, high = max(1, c * size + 1 - flank), length if c == n - 1 else min(length, (c + 1) * size + flank)
                left = sorted((s, e, f"{contig}-{k}") for q, src, k, s, e in rows if (q, src) == (contig, source) and low <= s and e <= high and s >= start)
                over = next((x for x in left if x[0] <= end < x[1]), None)
                want |= {(contig, source, c, s, e, i) for s, e, i in left if c == n - 1 or s <= end and (e <= end if over is None else (s, e, i) <= over)}
                start = (end if over is None else over[1]) + 1
    df = spark.createDataFrame([*rows, (None, "a", 1, 5, 9), (1, None, 1, 5, 9), (1, "a", 999, None, 7)], "seqid long, source string, k int, s long, e long").repartition(3)
    for most in (1 << 13, 100):
        got = junctions.of_features(df, ["seqid", "source"], "id", size, flank, made=F.concat_ws("-", "seqid", "k"), most=most)
        found = [tuple(x) for x in got.select("seqid", "source", "chunk", "s", "e", "id").collect()]
        assert len(found) == len(set(found)) and set(found) == want
        if most > 3100:
            plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
            assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert junctions.of_features(df.where("false").withColumn("id", F.lit("")), ["seqid", "source"], "id", size, flank).count() == 0


@pytest.mark.parametrize("allow", [0.0, 0.3])
def test_opposite_strands(spark, allow):
    r = random.Random(3)
    genes, exons = [], {}
    for g in range(150):
        s = r.randrange(1, 1800)
        parts, at = [], s
        for _ in range(r.randrange(1, 4)):
            parts.append((at, at + r.randrange(5, 25)))
            at = parts[-1][1] + r.randrange(3, 15)
        exons[g] = parts
        genes.append((1 + g % 2, g, r.choice([1, -1]), parts[0][0], parts[-1][1], r.randrange(10, 40), r.choice([True, False, False, None])))

    def compete(a, b):
        if a[0] != b[0] or a[3] > b[4] or b[3] > a[4]:
            return False
        shared = sum(max(0, min(p[1], q[1]) - max(p[0], q[0]) + 1) for p in exons[a[1]] for q in exons[b[1]])
        n = min(sum(e - s + 1 for s, e in exons[x[1]]) for x in (a, b))
        return shared > allow * n if allow else True

    sure = [g for g in genes if g[6]]
    left = [g for g in genes if not g[6] and not any(h[2] != g[2] and compete(g, h) for h in sure)]
    kept = []
    for g in sorted(left, key=lambda x: (-x[5], x[1])):
        if not any(compete(g, k) for k in kept):
            kept.append(g)
    frame = spark.createDataFrame(genes, "seqid long, gene long, strand int, s long, e long, residues long, sure boolean").repartition(3)
    parts = spark.createDataFrame([(g, s, e) for g, x in exons.items() for s, e in x], "gene long, s long, e long")
    got = competition.opposite_strands(frame, ["seqid"], "gene", F.col("sure"), [F.desc("residues"), F.col("gene")], parts, allow)
    assert len(kept) > 10 and len(left) > len(kept)
    assert sorted(x.gene for x in got.collect()) == sorted(g[1] for g in (*sure, *kept))


def test_consensus(spark):
    r = random.Random(9)
    hits = {}
    for bag in range(6):
        for hit in range(5):
            at = r.randrange(1, 120)
            for _ in range(r.randrange(1, 5)):
                e = at + r.randrange(3, 30)
                hits.setdefault((bag, hit), []).append((at, e))
                at = e + r.randrange(2, 40)
    hits[7, 0] = [(5, 9)]
    want = []
    for bag in {b for b, _ in hits}:
        own = {h: x for (b, h), x in hits.items() if b == bag}
        exon = {i for x in own.values() for s, e in x for i in range(s, e + 1)}
        intron = {i for x in own.values() for p, q in zip(x, x[1:], strict=False) for i in range(p[1] + 1, q[0])}
        state = {i: -1 if i in exon and i in intron else 1 if i in exon else 2 for i in exon | intron}

        def walk(i, step, state=state):
            """The exon runs that agreed bases lead to, the own one first."""
            runs = []
            while state.get(i, 0) > 0:
                begin, kind = i, state[i]
                while state.get(i) == kind:
                    i += step
                if kind == 1:
                    runs.append(tuple(sorted((begin, i - step))))
            return runs

        for hit, blocks in own.items():
            blocks = [list(x) for x in blocks]
            before, behind = walk(blocks[0][0], -1) if state[blocks[0][0]] == 1 else [], walk(blocks[-1][1], 1) if state[blocks[-1][1]] == 1 else []
            if before:
                blocks[0][0] = before[0][0]
            if behind:
                blocks[-1][1] = behind[0][1]
            want += [(bag, hit, s, e) for s, e in (*before[1:], *blocks, *behind[1:])]
    frame = spark.createDataFrame([(b, h, s, e) for (b, h), x in hits.items() for s, e in x], "bag long, hit long, s long, e long").repartition(3)
    got = consensus.extended(frame, ["bag"])
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)
    assert len(want) > sum(map(len, hits.values()))


def revcomp(x):
    return x.translate(PAIR)[::-1]


def by_hand(contig, strand, exons, offset, end):
    """Walks codon by codon; the contig is fetched in strides of 100."""
    s, e, n = exons[0][0], exons[-1][1], len(contig)
    seq = "".join(contig[p - 1:q] for p, q in exons)
    seq = seq if strand > 0 else revcomp(seq)
    has_stop, repeat, z, grown, edge = TABLE.get(seq[end - 4:end - 1]) == "*", 0, end, seq, e if strand > 0 else s
    while not has_stop:
        z += 3
        if z > len(grown) + 1:
            last = edge
            edge = min(n, edge + 100) if strand > 0 else max(1, edge - 100)
            grown += contig[last:edge] if strand > 0 else revcomp(contig[edge - 1:last - 1])
        if z > len(grown) + 1:
            break
        codon = grown[z - 4:z - 1]
        repeat = repeat + 1 if codon not in TABLE else 0
        if repeat > 5 and z - len(seq) + 1 > 0:
            break
        if TABLE.get(codon) == "*":
            has_stop, end = True, z
    more = max(0, end - 1 - len(seq))
    has_start, repeat, i, grown, edge = seq[offset:offset + 3] == "ATG", 0, offset, seq, s if strand > 0 else e
    first = offset
    while not has_start:
        i -= 3
        if i < 0:
            last = edge
            edge = max(1, edge - 100) if strand > 0 else min(n, edge + 100)
            add = contig[edge - 1:last - 1] if strand > 0 else revcomp(contig[last:edge])
            grown = add + grown
            i += len(add)
        if i < 0:
            break
        codon = grown[i:i + 3]
        if TABLE.get(codon) == "*":
            break
        if codon == "ATG":
            has_start, first = True, i - (len(grown) - len(seq))
            break
        repeat = repeat + 1 if codon not in TABLE else 0
        if repeat > 5 and len(grown) - len(seq) - offset > 0:
            break
    j = offset
    while not has_start:
        j += 3
        if j > len(seq) - 3 or TABLE.get(seq[j:j + 3]) == "*":
            break
        if seq[j:j + 3] == "ATG":
            has_start, first = True, j
    before = max(0, -first)
    return (s - (before if strand > 0 else more), e + (more if strand > 0 else before), first + before, end + before, has_start, has_stop)


@pytest.mark.parametrize("size", [60, 97, 5000])
def test_codon_walk(spark, size):
    r = random.Random(21)
    rare = ["GCC", "AAC", "CTG", "GGT", "CCA", "CAC"]
    contigs = {}
    for k in range(4):
        seq = "".join(r.choice(rare) if r.random() < 0.985 else r.choice(["ATG", "TAA", "TGA", "TTA", "CAT", "CTA"]) for _ in range(700))
        at = 900 + 40 * k
        contigs[k] = seq[:at] + "N" * 30 + seq[at + 30:]
    rows, want = [], {}
    for tx in range(120):
        seqid, strand = tx % 4, r.choice([1, -1])
        n = len(contigs[seqid])
        at, exons = r.randrange(1, n - 260), []
        for _ in range(r.randrange(1, 4)):
            exons.append((at, at + r.randrange(30, 60)))
            at = exons[-1][1] + r.randrange(10, 30)
        seq = "".join(contigs[seqid][p - 1:q] for p, q in exons)
        seq = seq if strand > 0 else revcomp(seq)
        offset = r.choice([0, 1, 5, 12])
        end = offset + 1 + 3 * r.randrange(2, (len(seq) - offset) // 3 + 1)
        rows.append((tx, seqid, strand, exons[0][0], exons[-1][1], seq, offset, end))
        want[tx] = by_hand(contigs[seqid], strand, exons, offset, end)
    chunks = frames.chunked(spark.createDataFrame(list(contigs.items()), "seqid long, seq string"), size).cache()
    frame = spark.createDataFrame(rows, "tx long, seqid long, strand int, s long, e long, seq string, offset long, end long").repartition(3)
    got = {x.tx: (x.s, x.e, x.offset, x.end, x.has_start, x.has_stop) for x in codons.adjusted(frame, chunks, size).collect()}
    assert got == want
    kinds = [w[4:] for w in want.values()]
    assert kinds.count((True, True)) > 5 and kinds.count((False, False)) > 0
    assert codons.adjusted(frame.where("false"), chunks, size).count() == 0
