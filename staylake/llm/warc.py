"""WARC records and a Merkle fixity audit of replicas.

Records are hashed and the hashes combined into one tree per WARC file: a
node covers an ordered range of record slots and byte offsets, its hash is
that of its children's hashes and offsets.  Two replicas are compared by their
roots; only the branches that differ are read further, level by level, until
the damaged records are reached.  Trees are tables partitioned by level, so a
step reads one level and keeps the children of differing nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylake.llm.common import stored

FILE_RECORDS = 1000
FANOUT_BITS = 4  # 16 children
LEVELS = 4  # 16^3 slots in a file at least: levels 0 (records) to 3 (root)


def _file(file_records: int) -> Column:
    """The file of a page id, rounded down in whole numbers."""
    return F.expr(f"page_id div {file_records} - if(page_id % {file_records} < 0, 1, 0)")


def warc_records(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """(file, slot, page_id, position, length, record) of response records.

    Pages are dealt to files by their id, ``file_records`` ids to a file, in
    id order; ``position`` is the record's byte offset in its file.  A null
    url or html is written empty; rows with a null page_id have no place in a
    file and are left out.  Rows that repeat a page_id follow each other in
    the same slot, ordered by content.  Other columns are ignored.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.col("page_id").cast("string"), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    record = F.concat(head, html, F.lit("\r\n\r\n"))
    rows = pages.where("page_id is not null").select(
        _file(file_records).cast("long").alias("file"),
        F.pmod("page_id", F.lit(file_records)).cast("int").alias("slot"),
        F.col("page_id").cast("long").alias("page_id"), record.alias("record"))
    return rows.select("file", "slot", "page_id",
                       F.octet_length("record").cast("long").alias("length"), "record")


def leaves(records: DataFrame) -> DataFrame:
    """(file, slot, page_id, position, length, copies, digest) of each slot.

    The digest is the SHA-256 of the slot's record; of several rows in a slot
    the digests are combined whatever their order.  Only digests and lengths are grouped
    and ordered, never records.
    """
    hashed = records.select("file", "slot", "page_id", "length",
                            F.sha2(F.col("record").cast("binary"), 256).alias("h"))
    many = F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), F.min("h"), F.max("h"),
                              F.bit_xor(F.xxhash64("h")).cast("string"),
                              F.sum(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"))
                              .cast("string")), 256)
    one = hashed.groupBy("file", "slot").agg(
        F.min("page_id").alias("page_id"), F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("copies"),
        F.when(F.count(F.lit(1)) == 1, F.min("h")).otherwise(many).alias("digest"))
    # At most file_records slots to a file, so the running sum is bounded.
    earlier = Window.partitionBy("file").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1)
    return one.withColumn("position", F.coalesce(F.sum("length").over(earlier), F.lit(0)))


def _node(hash_: Column, begin: Column, end: Column) -> Column:
    return F.concat_ws(":", hash_, begin.cast("string"), end.cast("string"))


def merkle_tree(slots: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(file, node, begin, end, hash, level): a written table by level."""
    level0 = slots.select(
        "file", F.col("slot").alias("node"), F.col("position").alias("begin"),
        (F.col("position") + F.col("length")).alias("end"), F.col("digest").alias("hash"),
        F.lit(0).alias("level"))
    tree, below = level0, level0
    for level in range(1, levels):
        children = F.sort_array(F.collect_list(F.struct(
            "node", _node(F.col("hash"), F.col("begin"), F.col("end")).alias("part"))))
        below = (below.withColumn("parent", F.shiftright("node", FANOUT_BITS))
                 .groupBy("file", "parent").agg(
                     F.min("begin").alias("begin"), F.max("end").alias("end"),
                     F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(
                         ":", c["node"].cast("string"), c["part"])), ","), 256).alias("hash"))
                 .select("file", F.col("parent").alias("node"), "begin", "end", "hash",
                         F.lit(level).alias("level")))
        tree = tree.unionByName(below)
    return stored(tree, "warc-tree", partition_by=["level"])


def differing(a: DataFrame, b: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(file, node) of the records that differ, by descent from the roots."""
    branch = None
    for level in range(levels - 1, -1, -1):
        sides = []
        for tree in (a, b):
            nodes = tree.where(F.col("level") == level).select("file", "node", "begin", "end",
                                                               "hash")
            if branch is not None:
                nodes = nodes.withColumn("parent", F.shiftright("node", FANOUT_BITS)).join(
                    branch.withColumnRenamed("node", "parent"), ["file", "parent"], "left_semi"
                ).drop("parent")
            sides.append(nodes.select("file", "node", F.struct("begin", "end", "hash").alias("of")))
        left, right = sides
        branch = stored(
            left.alias("l").join(right.alias("r"), ["file", "node"], "full")
            .where(~F.col("l.of").eqNullSafe(F.col("r.of"))).select("file", "node"),
            "warc-branch")
    return branch


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """One row for every record slot in which two replicas differ.

    file, slot, page_id, position and length as in the original (as in the
    replica for a record that only it has), both digests and a status:
    'changed', 'missing' (not in the replica), 'extra' (only there) or 'moved'
    (same content at another offset).  Equal or empty replicas give no rows.
    """
    a, b = stored(leaves(original), "warc-leaves"), stored(leaves(replica), "warc-leaves")
    found = differing(merkle_tree(a), merkle_tree(b)).withColumnRenamed("node", "slot")
    left = a.join(found, ["file", "slot"], "left_semi").alias("l")
    right = b.join(found, ["file", "slot"], "left_semi").alias("r")
    status = (F.when(F.col("r.digest").isNull(), "missing")
              .when(F.col("l.digest").isNull(), "extra")
              .when(F.col("l.digest") == F.col("r.digest"), "moved").otherwise("changed"))
    both = [F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in ("page_id", "position", "length")]
    return left.join(right, ["file", "slot"], "full").select(
        "file", "slot", *both, F.col("l.digest").alias("digest"),
        F.col("r.digest").alias("replica_digest"), status.alias("status"))


# The replica that the query audits: a copy of the records with known damage.
# One page id in 47 has its html written backwards (same length), and every
# seventh file lost its last 25 slots.
def damaged_copy(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    html = F.when(F.pmod("page_id", F.lit(47)) == 5, F.reverse("html")).otherwise(F.col("html"))
    kept = pages.where(
        ~((F.pmod(_file(file_records), F.lit(7)) == 3)
          & (F.pmod("page_id", F.lit(file_records)) >= file_records - 25)))
    return kept.withColumn("html", html)


ORACLE_SQL = r"""
WITH rec AS (
  SELECT page_id // 1000 AS file, CAST(page_id % 1000 AS INTEGER) AS slot, page_id,
         coalesce(html, '') AS html,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Type: text/html' || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
         || chr(13) || chr(10) AS head
  FROM pages WHERE page_id IS NOT NULL),
pair AS (
  SELECT file, slot, page_id, strlen(head) + strlen(html) + 4 AS length,
         sha256(head || html || chr(13) || chr(10) || chr(13) || chr(10)) AS digest,
         CASE WHEN file % 7 = 3 AND slot >= 975 THEN NULL
              ELSE sha256(head || CASE WHEN page_id % 47 = 5 THEN reverse(html) ELSE html END
                          || chr(13) || chr(10) || chr(13) || chr(10)) END AS replica_digest
  FROM rec),
placed AS (
  SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY slot) - length AS BIGINT) AS position
  FROM pair)
SELECT file, slot, page_id, position, length, digest, replica_digest,
       CASE WHEN replica_digest IS NULL THEN 'missing' ELSE 'changed' END AS status
FROM placed WHERE digest IS DISTINCT FROM replica_digest
"""
