"""Secret scan with corpus-wide ownership of each found value.

1. Each text is scanned for the base kinds: ``assign`` (a named value), ``access`` (an access key id) and ``hex``; and for
   ``opaque`` candidates: runs of 32 or more key characters with lower case, upper case and digits, of at least 4 bits of
   entropy per character, outside every base span. Only spans and digests of the values leave the scan, no text.
2. Digests are counted over the whole corpus: distinct repositories (documents, unless a column is named) and distinct
   owners (sources). Copies inside one owner are reduced first, so a value that half of all rows quote costs no more
   than any other.
3. A value that ``EXAMPLE_OWNERS`` or more owners have is a copied example, any other is owner-specific and looks live.
   Base spans always stay, with that verdict; opaque candidates are added as spans if fewer than ``added`` owners have
   them. The registered query and the pipeline add all that are no examples (``added`` = ``EXAMPLE_OWNERS``), and there
   copies of one text count for the first of their owners only (``independent``). The number of repositories is reported;
   it is no part of the verdict, as a live value of one owner stays live however many of its documents have it.

Spans are code point offsets, end exclusive. Null and empty texts have none; a null owner counts as one owner; repeated
rows are reported each; an empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import map_arrow, numbered, table, unused
from spendlink.sources.shared import materialize

KINDS = ("assign", "access", "hex", "opaque")
EXAMPLE_OWNERS = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Runs shorter than the least length cannot pass, and a passing match always is a whole run.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}")
#: For a filter on the JVM side: texts without such a run have no opaque candidate.
OPAQUE_RUN = "[A-Za-z0-9+/_=-]{32,}"
MIN_BITS = 4.0


def _looks_random(value: str) -> bool:
    if not (re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= MIN_BITS


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of all candidates, by start and kind; ``kind`` is an index into ``KINDS``."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base, at, reach = sorted((s, e) for s, _, e, _ in found), 0, 0
    for m in OPAQUE.finditer(text):  # both lists go by start: one walk through either
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][1])
            at += 1
        if reach <= m.start() and _looks_random(m[0]):
            found.append((m.start(), 3, m.end(), m[0]))
    return sorted(found)


def digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode(), digest_size=16).digest()


SPAN = "struct<start:int,kind:int,stop:int,digest:binary>"
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("digest", pa.binary())])


def candidates(docs: DataFrame) -> DataFrame:
    """``whole`` (digest of the text) and ``found`` (array of spans with value digests) for docs(row, doc_id, owner, text);
    the text is dropped."""

    def work(batch):
        lists = [
            [{"start": s, "kind": k, "stop": e, "digest": digest(v)} for s, k, e, v in scan(t.as_py() or "")] for t in batch.column(3)
        ]
        whole = pa.array([digest(t.as_py()) if own else None for t, own in zip(batch.column(3), lists, strict=True)], pa.binary())
        return pa.record_batch([*batch.columns[:3], whole, pa.array(lists, pa.list_(_SPAN))], ["row", "doc_id", "owner", "whole", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, owner string, whole binary, found array<{SPAN}>"
    return map_arrow(docs.select("row", "doc_id", "owner", "text"), work, schema)


def ownership(found: DataFrame, independent: bool = False) -> DataFrame:
    """(digest, owners, repositories): distinct owners and repositories of every value."""
    seen = found.select("row", "owner", "whole", F.explode("found").alias("f")).select("f.digest", "owner", "whole", "row").distinct()
    if independent:
        by_text = seen.groupBy("digest", "whole").agg(F.min("owner").alias("owner"), F.count(F.lit(1)).alias("n"))
        by_owner = by_text.groupBy("digest", "owner").agg(F.sum("n").alias("n"))
        return by_owner.groupBy("digest").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))
    by_owner = seen.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("digest").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def scan_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", examples: int = EXAMPLE_OWNERS,
    row_col: str | None = None, added: int = 2, independent: bool = False,
) -> DataFrame:
    """(row, doc_id, spans): every document row; spans are structs (start, kind, stop, owners, repositories, example).
    ``row_col`` names the stored row numbers if there are some; see the module's text for the last two."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    narrow = docs.select(
        row.alias("row"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), F.col(text_col).alias("text"),
    )
    found = materialize(candidates(narrow), "candidates")
    owned = ownership(found, independent)
    spans = found.select("row", F.explode("found").alias("f")).select("row", "f.*").join(owned, "digest")
    spans = spans.filter((F.col("kind") < 3) | (F.col("owners") < added))
    example = (F.col("owners") >= examples).alias("example")
    per_row = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "owners", "repositories", example))).alias("spans")
    )
    return found.select("row", "doc_id").join(per_row, "row", "left")


def _listed(spans, kinds: int):
    names = F.array(*map(F.lit, KINDS))
    kept = F.filter(spans, lambda s: s["kind"] < kinds)
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def report(scanned: DataFrame) -> DataFrame:
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,owners:bigint,repositories:bigint,example:boolean>>")
    rows = scanned.withColumn("s", F.coalesce("spans", none))

    def counted(kind):
        return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("bigint")

    count = [counted(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select(
        "doc_id", *count[:3], F.sha2(_listed(F.col("s"), 3), 256).alias("base_sha256"), _listed(F.col("s"), 4).alias("spans"),
        count[3], F.size(F.filter("s", lambda s: s["example"])).cast("bigint").alias("n_example"),
    )


def masked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", added: int = 2, independent: bool = False
) -> DataFrame:
    """``docs`` with every reported span replaced by ``<secret:kind>``; texts without spans stay as they are.

    Base spans need no statistics and are masked in the scan. Only texts that may hold an opaque candidate meet the
    ownership counts, by a join on the digests of their candidates. Rows are
    numbered once, in a written table.
    """
    schema = docs.schema
    at = schema.fieldNames().index(text_col)

    def mask(text, spans):
        out, last = [], 0
        for start, kind, stop in spans:
            if stop <= last:
                continue
            out += [text[last : max(last, start)], f"<secret:{KINDS[kind]}>"]
            last = stop
        return "".join(out) + text[last:]

    def base(batch):
        texts = [t.as_py() for t in batch.column(at)]
        texts = [t and mask(t, [(s, k, e) for s, k, e, _ in scan(t) if k < 3]) for t in texts]
        return pa.record_batch([pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    may_hold = F.coalesce(F.col(text_col).rlike(OPAQUE_RUN), F.lit(False))
    row, spans = unused(docs, "__row"), unused(docs, "__spans")
    stored = numbered(docs, row)
    plain = map_arrow(stored.filter(~may_hold).drop(row), base, schema)
    scanned = scan_corpus(stored, id_col, text_col, owner_col, row_col=row, added=added, independent=independent)
    live_spans = F.transform(F.filter("spans", lambda s: s["kind"] == 3), lambda s: F.struct(s["start"], s["stop"]))
    keyed = scanned.filter(F.exists("spans", lambda s: s["kind"] == 3)).select(F.col("row").alias(row), live_spans.alias(spans))
    # Rows meet by number: repeated or null ids do not meet.
    with_spans = stored.filter(may_hold).join(keyed, row, "left").drop(row)

    def both(batch):
        texts = []
        for t, s in zip(batch.column(at), batch.column(len(schema)), strict=True):
            t, live = t.as_py(), {(x["start"], x["stop"]) for x in s.as_py() or ()}
            texts.append(t and mask(t, [(a, k, e) for a, k, e, _ in scan(t) if k < 3 or (a, e) in live]))
        columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns[: len(schema)])]
        return pa.record_batch(columns, names=schema.fieldNames())

    return plain.unionByName(map_arrow(with_spans, both, schema))


COLUMNS = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_opaque", "n_example"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_corpus(table(spark, sf_dir, "documents"), added=EXAMPLE_OWNERS, independent=True)
    return report(scanned).select(*COLUMNS)
