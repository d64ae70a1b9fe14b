r"""Secret scan with multipart credential linking, in DataFrame expressions only.

Strong patterns are reported wherever they match.  Weak candidates - an account name, a bare
random-looking token, an endpoint - are common in clean text, and are reported only if a part of
the role that completes a credential lies in their scope (``SCOPE`` code points around them): an
identifier or an endpoint needs a secret, a bare token needs an identifier.  The parts are joined
as intervals: positions are cut into buckets of one scope, each weak part looks into its own and
the two neighbouring buckets by an equality join, and the distance is tested in the join.

Positions come from the pieces between matches: ``split`` gives the gaps, ``regexp_extract_all``
the matches, and a running sum of both the offsets, in code points.

Defined cases: a null text is empty; equal rows get equal spans; a null doc_id is a key like any
other; weak parts that overlap a strong span are dropped; an empty table gives an empty result;
further columns are passed through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: kinds in report order, their patterns and least lengths (of the group named)
KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 6
# runs shorter than the least length are no matches, so the least length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
IDENT = r"(?i:\b(?:client_?id|access_?key_?id|user_?name|login|account))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}"
BLOB = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])"
        r"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = (r"https?://[^\x00-\x20\"'<>]+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.])"
            r"|(?i:\b(?:host|endpoint|server))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._:/-]{4,}")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "ident": IDENT, "blob": BLOB, "endpoint": ENDPOINT}
BASE = KINDS[:3]
#: The roles of each kind's parts, and the role that completes a weak one.
ROLE = {"assign": "secret", "hex": "secret", "blob": "secret", "access": "identifier", "ident": "identifier",
        "endpoint": "endpoint"}
NEEDS = {"ident": "secret", "endpoint": "secret", "blob": "identifier"}
#: A weak part's scope, in code points between two spans.
SCOPE = 400

REDACTED = "[SECRET]"


def _parts(text, kind: str) -> F.Column:
    """array<struct<kind, gap, len, ok>> of one kind's matches in a text."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if kind == "assign":
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        found = F.arrays_zip(found.alias("m"), value.alias("v"))
    gaps = F.split(text, pattern, -1)
    item = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, m: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.length(gap).alias("gap"),
        F.length(m["m"] if kind == "assign" else m).alias("len"),
        (F.length(m["v"]) >= ASSIGN_LEAST if kind == "assign" else F.lit(True)).alias("ok")))
    return F.when(F.regexp_like(text, F.lit(pattern)), item)


def _pick(names, values):
    return reduce(lambda acc, k: acc.when(F.col("kind") == KINDS.index(k), values[k]), names, F)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with sec_spans: array<struct<start, kind, end, seen>> sorted by start, then kind
    (an index into ``KINDS``); start and end in code points, end exclusive; seen: the largest end
    of the spans before.  Never null."""
    docs = docs.drop("sec_spans")                      # an old column of that name is replaced
    body = F.coalesce(F.col(text), F.lit(""))
    empty = F.expr("cast(array() as array<struct<kind:int,gap:int,len:int,ok:boolean>>)")
    parts = F.concat(*[F.coalesce(_parts(body, k), empty) for k in KINDS])
    # the patterns run once over each text, on the side that looks for parts; the side that keeps the
    # rows needs only the text's key
    rows = docs.withColumn("_sec_key", F.sha2(body, 256))
    some = (rows.filter(F.regexp_like(body, F.lit("|".join(f"(?:{PATTERNS[k]})" for k in KINDS))))
            .select(F.col(doc_id).alias("id"), F.col("_sec_key").alias("key"), parts.alias("parts"))
            .groupBy("id", "key").agg(F.first("parts").alias("parts")))
    one = some.select("id", "key", F.posexplode("parts").alias("i", "p")).select("id", "key", "i", "p.*")
    upto = Window.partitionBy("id", "key", "kind").orderBy("i")
    spans = (one.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).filter("ok")
             .select("id", "key", "kind", (F.col("end") - F.col("len")).alias("start"), "end"))
    strong = spans.filter(F.col("kind") < len(BASE))
    weak = spans.filter(F.col("kind") >= len(BASE))
    linked = _linked(spans, weak, scope)
    free = linked.join(_overlapped(linked, strong, scope),
                       F.col("id").eqNullSafe(F.col("o_id")) & (F.col("key") == F.col("o_key"))
                       & (F.col("kind") == F.col("o_kind")) & (F.col("start") == F.col("o_start")), "left_anti")
    before = Window.partitionBy("id", "key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    found = (strong.unionByName(free).withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0)))
             .groupBy("id", "key")
             .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "seen"))).alias("sec_spans"))
             .select(F.col("id").alias("_sec_id"), F.col("key").alias("_sec_found"), "sec_spans"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,seen:bigint>>)")
    return (rows.join(found, rows[doc_id].eqNullSafe(F.col("_sec_id")) & (F.col("_sec_key") == F.col("_sec_found")), "left")
            .withColumn("sec_spans", F.coalesce("sec_spans", none)).drop("_sec_key", "_sec_found", "_sec_id"))


def _buckets(first, last, scope: int) -> F.Column:
    return F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope))).alias("bucket")


def _linked(spans: DataFrame, weak: DataFrame, scope: int) -> DataFrame:
    """The weak parts with a completing part within ``scope`` code points; each comes out once.

    Both sides are cut into buckets of ``scope`` positions.  A part lies in every bucket it
    covers, so that long spans are found from either end."""
    role = _pick(ROLE, {k: F.lit(v) for k, v in ROLE.items()})
    need = _pick(NEEDS, {k: F.lit(v) for k, v in NEEDS.items()})
    near = weak.select("*", need.alias("need"),
                       _buckets(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope, scope))
    have = spans.select(F.col("id").alias("h_id"), F.col("key").alias("h_key"), F.col("kind").alias("h_kind"),
                        F.col("start").alias("h_start"), F.col("end").alias("h_end"), role.alias("role"),
                        _buckets(F.col("start"), F.col("end") - 1, scope)).withColumnRenamed("bucket", "h_bucket")
    hit = (F.col("id").eqNullSafe(F.col("h_id")) & (F.col("key") == F.col("h_key")) & (F.col("bucket") == F.col("h_bucket"))
           & (F.col("need") == F.col("role"))
           & (F.col("h_start") <= F.col("end") + scope) & (F.col("start") <= F.col("h_end") + scope)
           & ~((F.col("h_kind") == F.col("kind")) & (F.col("h_start") == F.col("start"))))
    return near.join(have, hit, "left_semi").select("id", "key", "kind", "start", "end").distinct()


def _overlapped(weak: DataFrame, strong: DataFrame, scope: int) -> DataFrame:
    """The weak spans that share a code point with a strong one, by the same buckets."""
    over = (F.col("id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")) & (F.col("bucket") == F.col("s_bucket"))
            & (F.col("start") < F.col("s_end")) & (F.col("s_start") < F.col("end")))
    have = strong.select(F.col("id").alias("s_id"), F.col("key").alias("s_key"), F.col("start").alias("s_start"),
                         F.col("end").alias("s_end"),
                         _buckets(F.col("start"), F.col("end") - 1, scope)).withColumnRenamed("bucket", "s_bucket")
    return (weak.select("*", _buckets(F.col("start"), F.col("end") - 1, scope)).join(have, over, "left_semi")
            .select(F.col("id").alias("o_id"), F.col("key").alias("o_key"), F.col("kind").alias("o_kind"),
                    F.col("start").alias("o_start")).distinct())


def span_list(spans, kinds=KINDS) -> F.Column:
    """kind:start:end of the given kinds, comma-joined, in order."""
    wanted = F.filter(spans, lambda s: s["kind"].isin([KINDS.index(k) for k in kinds]))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(scanned: DataFrame, text: str = "text", mark: str = REDACTED) -> DataFrame:
    """A scanned table with every span of its text replaced by ``mark``; overlapping spans become
    one.  Drops sec_spans; a null text stays null."""
    # a span that starts beyond all ends before it opens a new mark; others extend the last one
    opens = F.filter("sec_spans", lambda s, i: (i == 0) | (s["start"] > s["seen"]))
    pieces = F.transform(opens, lambda s: F.substring(
        F.col(text), s["seen"].cast("int") + 1, (s["start"] - s["seen"]).cast("int")))
    last = F.array_max(F.transform("sec_spans", lambda s: s["end"])).cast("int")
    tail = F.substring(F.col(text), last + 1, F.length(F.col(text)))
    return scanned.withColumn(text, F.when(
        F.size("sec_spans") > 0, F.concat(F.array_join(pieces, mark), F.lit(mark), tail)).otherwise(F.col(text))).drop("sec_spans")
