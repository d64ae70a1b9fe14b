"""The registered queries of this package: each applies its operator, with production
parameters, to the whole of its table and derives the columns of the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import archive, codes, credentials, density, hamming, mixture, periodic, pieces, ppm, quality, simhash, tokenfile, toxicity
from faultline.llm.common import saved, shared_folder, table, tokenizer_file


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hamming.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)
    return found.withColumnRenamed("id", "vec_id")


def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op3_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.labelled(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    archives = archive.write(table(spark, sf_dir, "pages"), folder)
    return archive.read(spark, folder, archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_seekable_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    files = tokenfile.write(table(spark, sf_dir, "documents"), folder, tokenizer or tokenizer_file("byte_bpe_50k.json"))
    return tokenfile.read(spark, folder, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.assess(docs, model).drop("text")


def op8_sentencepiece_wfst(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, model or tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.xxhash64("ids").alias("ids_xxh64"), "round_trip", "ids")


def op9_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = credentials.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("sec_spans", lambda s: s["kind"] == credentials.KINDS.index(kind))).cast("long")
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in credentials.BASE],
        F.sha2(credentials.span_list(F.col("sec_spans"), credentials.BASE), 256).alias("base_sha256"),
        credentials.span_list(F.col("sec_spans")).alias("spans"))


def op10_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixture.measure(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mixture.mix_measured(sized)
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
                        F.col("mix_copies").alias("copies"))


def _planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of op11: in those whose crc32(doc_id) is divisible by ten, the words from place
    a = g % n on repeat the first 1 + (n - a) / (3 + g % 8) of them, g the crc32 over ten."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("_h", h).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_words").cast("long"), F.floor(F.col("_h") / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    place = F.sequence(F.lit(0).cast("long"), n - 1)
    again = F.transform(place, lambda i: F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    text = F.when((F.col("_h") % 10 == 0) & (F.size("_words") > 0), F.array_join(again, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))

    def greater_exponent(x, y):
        order = x["length"] * y["period"] - y["length"] * x["period"]
        before = (order > 0) | ((order == 0) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
        return F.when(before, -1).otherwise(1)
    best = F.get(F.array_sort("runs", greater_exponent), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in periodic.RUN.names],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(remainder != 0))
    scored = toxicity.assess(docs, model)
    return scored.select("doc_id", (remainder == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "windows")


def op13_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = codes.compress(table(spark, sf_dir, "embeddings"))
    found = codes.with_label_error(saved(coded, "codes"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                        F.lit(codes.codebook_digest(codebooks)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_multi_index_hashing, op2_text_density, op3_ppm_scores, op4_simhash_components, op5_warc_zstd, op6_seekable_token_files, op7_quality_rules, op8_sentencepiece_wfst, op9_credential_linking, op10_pivotal_mixing, op11_periodic_runs,
                              op12_toxicity, op13_product_codes)}

def _product_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of op13 written out: nearest entries by a join with the codebook, floored means."""
    ctes = [f"""k as (select row_number() over (order by vec_id, embedding) as r, vec_id, label,
                      list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
               where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
            f"""w as (select len(v) // {parts} as w from k group by len(v) order by count(*) desc, len(v) limit 1)""",
            f"""p as (select r, p, v[p * w + 1:p * w + w] as x from k, w, range({parts}) t(p))""",
            f"""b0 as (select p, r - 1 as j, x as c from p where r <= {entries})"""]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} as materialized (
            select r, p, any_value(x) as x, (min(d * {entries} + j) // {entries})::bigint as d, (min(d * {entries} + j) % {entries})::int as j
            from (select r, p.p as p, j, x, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint as d
                  from p join b{t} b on p.p = b.p) group by r, p)""")
        if t < rounds:
            ctes.append(f"""b{t + 1} as materialized (
            select b.p, b.j, coalesce(m.c, b.c) as c from b{t} b left join (
                select p, j, list(m order by i) as c from (select p, j, i, floor_mean as m from (
                    select p, j, i, (sum(x[i + 1]) - ((sum(x[i + 1]) % count(*)) + count(*)) % count(*)) // count(*) as floor_mean
                    from a{t}, w, range(w) q(i) group by p, j, i)) group by p, j) m on b.p = m.p and b.j = m.j)""")
    return f"""with {", ".join(ctes)},
        e as (select r, string_agg(printf('%02x', j), '' order by p) as code, sum(d)::bigint as error from a{rounds} group by r),
        s as (select sha256(string_agg(x::varchar, ',' order by p, j, i)) as codebooks_sha256
              from (select p, j, i, c[i + 1] as x from b{rounds}, w, range(w) q(i)))
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
        from k join e using (r), s"""


ORACLES: dict[str, str] = {
    "op1_multi_index_hashing": """
        with w as (select len(embedding) as w from embeddings where vec_id is not null and embedding is not null
                   group by w order by count(*) desc, w limit 1),
             c as (select distinct vec_id, list_aggregate(list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end),
                                                          'string_agg', '')::bit as code
                   from embeddings, w where vec_id is not null and len(embedding) = w.w),
             d as (select q.vec_id as query_id, c.vec_id, bit_count(xor(q.code, c.code)) as distance
                   from c q join c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
             r as (select *, row_number() over (partition by query_id order by distance, vec_id) as rank from d)
        select query_id, rank, vec_id, distance from r where rank <= 10""",
    "op5_warc_zstd": """
        with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                          sha1(coalesce(html, '')) as payload_digest, coalesce(html, '') as payload from pages),
             g as (select payload, max(page_id) as latest from p where payload_bytes >= 1000 group by payload)
        select p.page_id, p.payload_bytes, p.payload_digest,
               case when g.latest <> p.page_id then 'revisit' else 'response' end as record_type,
               case when g.latest <> p.page_id then g.latest end as refers_to
        from p left join g on p.payload = g.payload""",
    "op13_product_codes": _product_codes_sql(),
}
