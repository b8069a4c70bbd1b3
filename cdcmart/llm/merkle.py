"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

DataFrame functions only. Sections are separated by blank lines, paragraphs by
line ends, clauses end after a mark of punctuation of any of the listed scripts.
A paragraph's hash is taken over the hashes of its clauses, a section's over its
paragraphs, the root over its sections. Equal roots mean equal texts; differing
branches show where texts differ.

Below the clause stand the leaves, runs of words that end where a word's own hash
says so, and after 512 characters at the latest. An edit changes the leaves
that it touches and no others, however long the clause is; the share of common
leaves says how alike texts are. Words of more than 24 characters (also text of
scripts without blanks) are cut by the hashes of their characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Latin marks, and those of other scripts: Armenian; Arabic and Urdu; Devanagari; Tibetan; Myanmar;
#: Ethiopic; Khmer; Chinese, Japanese and their wide forms
_LATIN = "[.!?,;:]"
_OTHER = ("[\u0589\u055c\u055d\u055e" "\u060c\u061b\u061f\u06d4" "\u0964\u0965" "\u0f0d\u0f0e" "\u104a\u104b"
          "\u1361-\u1368" "\u17d4\u17d5" "\u3002\u3001\uff01\uff1f\uff0c\uff1b\uff1a\uff0e\uff61\uff64]")
#: one range keeps most characters from the long list
_BEYOND = "[\u055c-\uffff]"
_CLAUSE_END = f"(?<={_LATIN})|(?<={_BEYOND})(?<={_OTHER})"
_MARKS = f"{_LATIN}+|(?={_BEYOND}){_OTHER}+"
#: a word with the blanks after it, a blank, or one character of a longer word
_ATOM = r"(?s)\S{1,24}+(?!\S)[^\S\n]*|\s|."
#: a leaf ends after a word in 4, or after a character in 16 inside a longer word
_WORD_BITS, _CHARACTER_BITS = 3, 15
LEAF_CHARS = 512
#: a leaf holds 48 bits of its text's hash, and in 16 bits its length
_LENGTH_BITS = 0xFFFF
#: at most so many id ranges; the driver holds one number for each
RANGES = 8192
LEAST_RANGE = 256


def paragraph_hashes(text: Column) -> Column:
    """The hash of each paragraph, over the hashes of its clauses."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.md5(
        F.array_join(F.transform(F.split(p, _CLAUSE_END, -1), lambda c: F.md5(c)), "")))


def section_hashes(paragraphs: Column) -> Column:
    """The hash of each section, over its paragraphs; a blank line is a
    paragraph without text and ends a section."""
    blank = F.md5(F.md5(F.lit("")))
    marked = F.array_join(F.transform(paragraphs, lambda h: F.when(h == blank, F.concat(h, F.lit("|"))).otherwise(h)), "")
    return F.transform(F.split(marked, "\\|", -1), lambda s: F.md5(s))


def root_hash(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ""), 256)


def _pieces(text: Column) -> Column:
    """The leaves' texts in their order. A line end, which no clause holds, stands
    for the end of a leaf until the cut."""
    clauses = F.regexp_replace(text, _MARKS, "$0\n")

    def ended(atom: Column) -> Column:
        bits = F.when(F.length(atom) == 1, _CHARACTER_BITS).otherwise(_WORD_BITS).cast("long")
        return F.when(F.xxhash64(atom).bitwiseAND(bits) == 0, F.concat(atom, F.lit("\n"))).otherwise(atom)
    runs = F.split(F.array_join(F.transform(F.regexp_extract_all(clauses, F.lit(_ATOM), F.lit(0)), ended), ""), "\n", -1)
    return F.flatten(F.transform(F.filter(runs, lambda r: r != ""), lambda r: F.when(
        F.length(r) <= LEAF_CHARS, F.array(r)).otherwise(F.regexp_extract_all(r, F.lit(f"(?s).{{1,{LEAF_CHARS}}}"), F.lit(0)))))


def leaves(text: Column) -> Column:
    """The distinct leaves as numbers: part of their hash and their length."""
    return F.array_distinct(F.transform(
        _pieces(text), lambda c: F.xxhash64(c).bitwiseAND(F.lit(~_LENGTH_BITS)).bitwiseOR(F.length(c).cast("long"))))


def _weight(of: Column) -> Column:
    return F.aggregate(of, F.lit(0).cast("long"), lambda s, x: s + x.bitwiseAND(F.lit(_LENGTH_BITS).cast("long")))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """Twice the length of the common leaves over the length of both sides'
    leaves: 1 for equal roots, 0 for nothing in common."""
    both = _weight(leaves_a) + _weight(leaves_b)
    common = 2 * _weight(F.array_intersect(leaves_a, leaves_b))
    return (F.when(root_a == root_b, F.lit(1.0)).when(both == 0, F.lit(0.0))
            .otherwise(common.cast("double") / both))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, sections, paragraphs, leaves per row of ``docs``.

    A null text counts as empty (one empty section). Repeated rows and null
    ids are answered each, an empty table gives an empty result, other columns
    are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return (rows.withColumn("paragraphs", paragraph_hashes(F.col("text")))
            .withColumn("sections", section_hashes(F.col("paragraphs")))
            .select("doc_id", root_hash(F.col("sections")).alias("fingerprint"), "sections", "paragraphs",
                    leaves(F.col("text")).alias("leaves")))


def differing_branches(a: DataFrame, b: DataFrame) -> DataFrame:
    """For two results of ``fingerprint`` over the same ids (each id once):
    doc_id, equal, and the positions (from 0) of the sections and paragraphs
    of ``a`` that do not occur in ``b`` and the other way round. An id that one
    side lacks, or that is null, is left out."""
    left, right = a.alias("a"), b.alias("b")

    def lacking(x: Column, y: Column) -> Column:
        places = F.transform(x, lambda h, i: F.when(~F.array_contains(y, h), i))
        return F.filter(places, lambda i: i.isNotNull())

    both = left.join(right, F.col("a.doc_id") == F.col("b.doc_id"))
    columns = [F.col("a.doc_id").alias("doc_id"), (F.col("a.fingerprint") == F.col("b.fingerprint")).alias("equal")]
    for level in ("sections", "paragraphs"):
        columns += [lacking(F.col(f"a.{level}"), F.col(f"b.{level}")).alias(f"{level}_a"),
                    lacking(F.col(f"b.{level}"), F.col(f"a.{level}")).alias(f"{level}_b")]
    return both.select(*columns)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, next_text: each row with the text of the row that follows
    in the order of doc_id (then text); after the last, the first.

    Rows are ordered inside ranges of ids, never all at once. The first rows of
    each range are copied to the range before it, where they stand at the end.
    The driver holds the smallest id of each range, at most ``RANGES`` numbers.
    A null id stands before all others and a null text is empty.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = max(LEAST_RANGE, -(-((high or 0) - (low or 0) + 1) // RANGES))
    ranged = rows.withColumn("range", F.coalesce(
        F.floor((F.col("doc_id").cast("decimal(20,0)") - (low or 0)) / width).cast("long"), F.lit(-1)))
    firsts = ranged.groupBy("range").agg(F.min("doc_id").alias("first")).orderBy("range").collect()
    before = [(r["range"], firsts[i - 1]["range"], r["first"]) for i, r in enumerate(firsts)]
    ghosts = docs.sparkSession.createDataFrame(before, "g_range long, g_before long, g_first long")
    placed = (ranged.join(F.broadcast(ghosts), (F.col("range") == F.col("g_range")) & F.col("doc_id").eqNullSafe(F.col("g_first")), "left")
              .select("doc_id", "text", F.explode(F.when(F.col("g_before").isNull(), F.array(
                  F.struct(F.col("range").alias("range"), F.lit(False).alias("ghost"))))
                  .otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("ghost")),
                                     F.struct(F.col("g_before").alias("range"), F.lit(True).alias("ghost"))))).alias("p"))
              .select("doc_id", "text", "p.range", "p.ghost"))
    order = Window.partitionBy("range").orderBy("ghost", F.asc_nulls_first("doc_id"), "text")
    return (placed.withColumn("next_text", F.lead("text").over(order)).where(~F.col("ghost"))
            .select("doc_id", "text", "next_text"))


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text: its last quarter of
    code points (rounded down) replaced by the first as many of the next
    document's, or all if that is shorter.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. See ``with_next`` for null ids, null texts and
    ties; a lone document is its own next; an empty table gives an empty result.
    """
    n, quarter = F.col("n_chars"), F.floor(F.col("n_chars") / 4).cast("int")
    trees = (with_next(docs, id_col, text_col)
             .withColumn("n_chars", F.length("text").cast("long"))
             .withColumn("edited", F.concat(F.left("text", (n - quarter).cast("int")), F.left("next_text", quarter)))
             .withColumn("own_sections", section_hashes(paragraph_hashes(F.col("text"))))
             .withColumn("edited_sections", section_hashes(paragraph_hashes(F.col("edited"))))
             .withColumn("next_sections", section_hashes(paragraph_hashes(F.col("next_text"))))
             .withColumn("own_leaves", leaves(F.col("text")))
             .withColumn("edited_leaves", leaves(F.col("edited")))
             .withColumn("next_leaves", leaves(F.col("next_text")))
             .withColumn("fingerprint", root_hash(F.col("own_sections")))
             .withColumn("edited_fingerprint", root_hash(F.col("edited_sections")))
             .withColumn("next_fingerprint", root_hash(F.col("next_sections"))))
    own, own_leaves = F.col("fingerprint"), F.col("own_leaves")
    return trees.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(own, own_leaves, F.col("edited_fingerprint"), F.col("edited_leaves")).alias("near_edited"),
        likeness(own, own_leaves, F.col("next_fingerprint"), F.col("next_leaves")).alias("near_next"))
