"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by the SHA-256 of its content. The ledger holds a row for each
pair of blob and rule version that has been scanned, with the spans found, so a scan only reads blobs
whose pair is not in the ledger yet; findings are joined back to every path that has the blob.

Spans follow from a split by the rule's pattern: the segments between matches and the matches
themselves, in turn, give every position. All work is done by DataFrame functions.

Null text counts as empty: a blob without findings. A text of any length is split as a whole. Spans that
start together go in the order of the rules. Repeated rows share a blob and each get its findings. Null ids
stay null. Other columns are kept, whatever their names; only a column spans is replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging

_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"

#: kind -> (pattern, group whose length counts, its least length), in the order of ties. A match under the length is dropped.
RULES = {
    "assign": (_KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
}
#: What a blob must contain for a rule to be worth splitting by: a literal, or a pattern.
HINTS = {"access": "AKIA", "hex": "[0-9a-f]{24}", "pem": "PRIVATE KEY-----", "github": "gh", "jwt": "eyJ"}
#: A private key's last line, and the lines of one without it: base64, or the fields of an encrypted key.
_PEM_END = r"^-----END [A-Z ]*PRIVATE KEY-----"
_PEM_LINES = (
    r"^(?:(?:[^\S\n]|\\[nr])*+\n?+[^\S\n]*+(?:[>#*]++[^\S\n]*+)?+"
    r"(?:(?:Proc-Type|DEK-Info):[^\n\\]*+(?:\n(?=\r?\n))?+|[A-Za-z0-9+/]{20,}+={0,2}+|[A-Za-z0-9+/=]++(?=[^\S\n]*+(?:\n|\z|\\[nr]))))*+"
)
BASE = ("assign", "access", "hex")
#: Follows from the rules, so that an edited rule finds no stale rows.
RULE_VERSION = hashlib.sha256(repr((RULES, HINTS)).encode()).hexdigest()[:16]

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,from:int>>"


#: Numbers that are summed in one block of ``_running``.
_BLOCK = 64


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column) -> Column:
    """The running sums of an array of ints: sums of blocks of ``_BLOCK`` first, then what stands before each block, then each item within its block."""
    add = lambda a, x: a + x
    block = lambda a, b: F.aggregate(F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), add)
    last = lambda a: F.greatest(F.floor((F.size(a) - 1) / _BLOCK), F.lit(0)).cast("int")
    upto = lambda sums: F.aggregate(sums, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    whole = lambda a: F.struct(a.alias("a"), upto(F.transform(F.sequence(F.lit(0), last(a)), lambda b: block(a, b))).alias("before"))
    own = lambda s, k: F.aggregate(F.slice(s["a"], k - k % _BLOCK + 1, k % _BLOCK + 1), F.lit(0), add)
    each = lambda s: F.transform(s["a"], lambda x, k: F.get(s["before"], F.floor(k / _BLOCK).cast("int")) + own(s, k))
    return _let(_let(numbers, whole), each)


def _spans(text: Column, kind: str) -> Column:
    """Spans of one rule: structs (start, rank, end, kind, from), from: where the secret itself starts."""
    pattern, group, least = RULES[kind]
    rank = list(RULES).index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    matches = F.struct(found.alias("all"), value.alias("value"), F.split(text, pattern, -1).alias("gap"))
    lengths = lambda m: F.transform(F.arrays_zip(F.slice(m["gap"], F.lit(1), F.size(m["all"])).alias("gap"), m["all"].alias("all")), lambda s: F.length(s["gap"]) + F.length(s["all"]))
    ended = lambda m: F.arrays_zip(_running(lengths(m)).alias("end"), m["all"].alias("all"), m["value"].alias("value"))
    span = lambda s: F.struct(
        (s["end"] - F.length(s["all"])).alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), (s["end"] - F.length(s["value"])).alias("from")
    )
    walked = F.transform(F.filter(_let(matches, ended), lambda s: F.length(s["value"]) >= least), span)
    hint = HINTS.get(kind)
    worth = text.rlike(pattern) if hint is None else text.rlike(hint) if "[" in hint else text.contains(hint)
    return F.when(worth, walked).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def scan(docs: DataFrame, ledger: DataFrame | None = None, text: str = "text", version: str = RULE_VERSION, only_new: bool = False) -> DataFrame:
    """The ledger (blob, rule_version, spans) with rows for all blobs of ``docs`` added; ``only_new``: these alone.

    Only pairs of blob and rule version that ``ledger`` does not hold are scanned. The new rows are
    stored in the session's shared folder.
    """
    blobs = docs.select(F.sha2(_text(text), 256).alias("blob"), _text(text).alias("body")).dropDuplicates(["blob"])
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == version).select("blob"), "blob", "left_anti")
    spans = F.array_sort(F.concat(*(_spans(F.col("body"), k) for k in RULES)))
    fresh = staging.stored(blobs.select("blob", F.lit(version).alias("rule_version"), spans.alias("spans")), "secret-ledger")
    return fresh if ledger is None or only_new else ledger.select("blob", "rule_version", "spans").unionByName(fresh)


def update(docs: DataFrame, folder: str, text: str = "text", version: str = RULE_VERSION) -> DataFrame:
    """The ledger kept in ``folder``, after the blobs of ``docs`` that it lacks have been scanned and added.

    The next call finds it there: only new blobs, and blobs of a new rule version, are scanned then. A folder
    without tables, as a first write that failed leaves it, is no ledger yet.
    """
    spark = docs.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = len(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")) or []) > 0
    fresh = scan(docs, spark.read.parquet(folder) if there else None, text, version, only_new=True)
    fresh.write.mode("append").parquet(folder)
    staging.drop(fresh)
    return spark.read.parquet(folder)


def located(docs: DataFrame, ledger: DataFrame, text: str = "text", version: str = RULE_VERSION) -> DataFrame:
    """``docs`` with the column spans of their blob; blobs without findings have an empty array."""
    key, blob, found = (staging.unused(docs.columns, n) for n in ("key", "blob", "found"))
    hits = ledger.where((F.col("rule_version") == version) & (F.size("spans") > 0)).select(F.col("blob").alias(blob), F.col("spans").alias(found))
    out = docs.withColumn(key, F.sha2(_text(text), 256)).join(hits, F.col(key) == F.col(blob), "left")
    return out.withColumn("spans", F.coalesce(found, F.expr(f"cast(array() as {_SPAN})"))).drop(key, blob, found)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _key_end(end: Column) -> Column:
    """Where the private key ends whose first line ends at ``end``: after the END line, or its base64 lines if none follows."""
    rest = F.substring(F.col("text"), end + 1, F.length("text"))
    dashes = F.instr(rest, "-----")
    last = F.when(dashes > 0, F.regexp_extract(F.substring(rest, dashes, F.lit(200)), _PEM_END, 0)).otherwise("")
    return end + F.when(last != "", dashes - 1 + F.length(last)).otherwise(F.length(F.regexp_extract(rest, _PEM_LINES, 0)))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (with spans) in which every secret is replaced by ``mark``; overlapping spans get one mark.

    Of an assignment only its value goes, the name before it stays. With a private key's first line, its
    span in the ledger, its body and last line go.
    """
    end = lambda s: F.when(s["kind"] == "pem", _key_end(s["end"])).otherwise(s["end"])
    ranges = F.array_sort(F.transform("spans", lambda s: F.struct(s["from"].alias("a"), end(s).alias("b"))))
    step = lambda acc, r: F.struct(
        F.when(
            r["a"] >= acc["at"], F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, r["a"] - acc["at"]), F.lit(mark))
        ).otherwise(acc["out"]).alias("out"),
        F.greatest(acc["at"], r["b"]).alias("at"),
    )
    done = F.aggregate(ranges, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    whole = F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))
    return docs.withColumn("text", F.when(F.size("spans") > 0, whole).otherwise(F.col("text"))).drop("spans")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table comes in two increments: the second scans those blobs alone that the first has not left in the ledger."""
    docs = staging.documents(spark, sf_dir).select("doc_id", "text")
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    ledger = scan(docs.where(~first), scan(docs.where(first)))
    found = located(docs, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _oracle(kind: str) -> str:
    pattern, group, least = RULES[kind]
    pattern = pattern.replace("'", "''")
    rank = list(RULES).index(kind)
    return f"""
  select blob, unnest(list_transform(range(1, len(m) + 1), lambda k: struct_pack(
      s := list_sum(list_transform(g[1:k], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0)::bigint,
      n := length(m[k]), v := length(w[k])))) as p, {rank} as rank, '{kind}' as kind, {least} as least
  from (select blob, regexp_extract_all(body, '{pattern}', 0) as m, regexp_extract_all(body, '{pattern}', {group}) as w, string_split_regex(body, '{pattern}') as g
        from blobs where regexp_matches(body, '{pattern}'))"""


ORACLE_SQL = f"""
with versions as (select doc_id, coalesce(text, '') as body, sha256(coalesce(text, '')) as blob from documents),
blobs as (select blob, any_value(body) as body from versions group by blob),
raw as ({reduce(lambda a, b: f"{a}{chr(10)}  union all{b}", map(_oracle, RULES))}),
spans as (select blob, rank, kind, p.s as s, kind || ':' || p.s || ':' || (p.s + p.n) as span from raw where p.v >= least),
ledger as (
  select blob, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
    string_agg(span, ',' order by s, rank) filter (where rank < {len(BASE)}) as base, string_agg(span, ',' order by s, rank) as spans
  from spans group by blob)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from versions left join ledger using (blob)
"""
