"""Column functions over sequence text, alignment strings and paths."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements of the IUPAC nucleotide codes.
IUPAC_FROM, IUPAC_TO = "ACGTUMRWSYKVHDBN", "TGCAAKYWSRMBDHVN"


def reverse_complement(seq: Column, mode: str = "iupac") -> Column:
    """Reverse complement. ``iupac`` keeps case and knows all codes; ``upper`` gives upper case and N for what is not
    ACGT; ``strict`` is null where other characters than ACGTN stand."""
    if mode == "iupac":
        return F.reverse(F.translate(seq, IUPAC_FROM + IUPAC_FROM.lower(), IUPAC_TO + IUPAC_TO.lower()))
    if mode == "upper":
        return F.reverse(F.translate(F.regexp_replace(F.upper(seq), "[^ACGT]", "N"), "ACGT", "TGCA"))
    if mode == "strict":
        return F.when(seq.rlike("^[ACGTN]*$"), F.reverse(F.translate(seq, "ACGT", "TGCA")))
    raise ValueError(mode)


def count_n(seq: Column) -> Column:
    """Number of N, either case."""
    return F.length(seq) - F.length(F.translate(seq, "Nn", ""))


def strip_n(seq: Column) -> Column:
    """Without any N."""
    return F.translate(seq, "Nn", "")


def trim_n(seq: Column) -> Column:
    """Without leading and trailing N."""
    return F.regexp_replace(seq, "^[Nn]+|[Nn]+$", "")


def split_at_n(seq: Column) -> Column:
    """The non-empty pieces between runs of N."""
    return F.array_remove(F.split(seq, "[Nn]+"), "")


def mask_lower(seq: Column) -> Column:
    """Soft-masked (lower-case) letters as x."""
    return F.regexp_replace(seq, "[a-z]", "x")


def cigar_ops(cigar: Column) -> Column:
    """array<struct<n, op>> of a CIGAR string; empty for '*' and null."""
    pieces = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+[MIDNSHP=X])"), 1)
    return F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, r"\d+", 0).cast("int"), F.right(p, F.lit(1))).cast("struct<n:int,op:string>"))


def cigar_reference_length(cigar: Column, seq_length: Column | None = None) -> Column:
    """Reference bases that an alignment spans (M, D, N, =, X); the sequence's length for a lone '='."""
    total = F.aggregate(cigar_ops(cigar), F.lit(0), lambda acc, x: acc + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["n"]).otherwise(0))
    return F.when(cigar == "=", seq_length).otherwise(total) if seq_length is not None else total


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order; empty for shorter sequences."""
    return F.when(F.length(seq) >= k, F.transform(F.sequence(F.lit(1), F.length(seq) - (k - 1)), lambda i: F.substring(seq, i, k))).otherwise(F.array().cast("array<string>"))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def species_of(path: Column) -> Column:
    """Species part of a reference path: the base name before '__'."""
    return F.substring_index(basename(path), "__", 1)


def reference_of(path: Column) -> Column:
    """Reference part of a reference path: what follows the first '__', null without one."""
    return F.get(F.split(basename(path), "__"), F.lit(1))


def bin_of(path: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def seqid_taxid(header: Column, known: Column) -> Column:
    """Taxonomy id of a header: an explicit token, else a numeric id, else the known accession's."""
    token = F.nullif(F.regexp_extract(header, r"(?:^|\|)kraken:taxid\|(\d+)", 1), F.lit(""))
    number = F.nullif(F.regexp_extract(header, r"^(\d+)$", 1), F.lit(""))
    return F.coalesce(token, number, known.cast("string"))


def is_number(text: Column) -> Column:
    return text.rlike("^[0-9.]*$")


def human_bases(n: Column) -> Column:
    """n in bp, Kb, Mb or Gb; each unit begins above its size."""
    out = F.format_string("%d bp", n.cast("long"))
    for unit, size in (("Kb", 1e3), ("Mb", 1e6), ("Gb", 1e9)):
        out = F.when(n > size, F.format_string(f"%.2f {unit}", n / size)).otherwise(out)
    return out


def longest_common_substring_length(a: Column, b: Column, most: int = 200) -> Column:
    """Length of the longest common substring of two short strings; null where a is longer than most."""
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), lambda i: F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(a) - i + 1, F.lit(1))), F.lit(0), lambda best, n: F.when((F.length(a) > 0) & F.contains(b, F.substring(a, i, n)), F.greatest(best, n)).otherwise(best)))
    return F.when(F.length(a) <= most, F.array_max(pieces))


def common_subsequence(a: str, b: str) -> str:
    """A longest common subsequence of two strings; of several, the one whose letters come last in a."""
    rows = [[0] * (len(b) + 1)]
    for x in a:
        up, row = rows[-1], [0]
        for j, y in enumerate(b):
            row.append(up[j] + 1 if x == y else max(up[j + 1], row[j]))
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.append(a[i - 1])
            i, j = i - 1, j - 1
        elif rows[i][j - 1] >= rows[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return "".join(reversed(out))


def common_subsequences(df, by: str, text: str):
    """by and subsequence: the fold of common_subsequence over each group's strings in order; for small groups of short strings."""
    from contigloom.runtime import ship

    ship(df.sparkSession)

    def run(pdf):
        return pdf.iloc[:1][[by]].assign(subsequence=functools.reduce(common_subsequence, sorted(pdf[text])))

    return df.filter(F.col(text).isNotNull()).select(by, text).groupBy(by).applyInPandas(run, f"`{by}` {dict(df.dtypes)[by]}, subsequence string")
