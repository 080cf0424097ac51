"""Sources, sinks, filters and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import filters, reports, segments
from ..sources import files
from ..sources.files import parquet
from . import E_SQL, events, query


@query("src6_path_resolution", """
select d.doc_id, case when l.doc_id is not null then 'labels/' || d.doc_id when b.item_id is not null then 'benchmark/' || d.doc_id else 'missing/' || d.doc_id end as path, l.doc_id is not null as select_frames
from documents d left join (select distinct doc_id from labels) l on d.doc_id = l.doc_id left join (select distinct item_id from benchmark) b on d.doc_id = b.item_id""")
def src6(spark, d):
    there = parquet(spark, d, "labels").select(F.concat(F.lit("labels/"), "doc_id").alias("path")).union(parquet(spark, d, "benchmark").select(F.concat(F.lit("benchmark/"), "item_id").alias("path")))
    rows = parquet(spark, d, "documents").select("doc_id")
    return files.resolved(rows, there, *(F.concat(F.lit(f"{k}/"), "doc_id") for k in ("labels", "benchmark", "missing"))).select("doc_id", "path", "select_frames")


@query("src9_parquet_scan", "select doc_id, source from documents where lang = 'fr' and n_chars > 1000")
def src9(spark, d):
    return parquet(spark, d, "documents").where("lang = 'fr' and n_chars > 1000").select("doc_id", "source")


@query("src10_extension_filter", """
with f as (select page_id, url || (['.WAV', '.mp3', '.txt', '.Flac', '', '.wav.bak'])[(page_id % 6)::int + 1] as path from pages)
select page_id, path from f where regexp_matches(lower(path), '[.](wav|mp3|flac|ogg|m4a|aac)$')""")
def src10(spark, d):
    ending = F.get(F.array(*map(F.lit, (".WAV", ".mp3", ".txt", ".Flac", "", ".wav.bak"))), (F.col("page_id") % 6).cast("int"))
    return files.with_extension(parquet(spark, d, "pages").select("page_id", F.concat("url", ending).alias("path")))


@query("src11_warm_up_split", "select s_suppkey, s_name, case when row_number() over (order by s_name) = 1 then 'warmup' else 'benchmark' end as phase from supplier")
def src11(spark, d):
    return files.warm_up_split(parquet(spark, d, "supplier").withColumnRenamed("s_name", "path")).select("s_suppkey", F.col("path").alias("s_name"), "phase")


@query("src12_prompt_manifest", """
select item_id, i::int as place, trim(case when i = 0 then text when i = 1 and item_id % 2 = 0 then reverse(text) when i = 1 then upper(text) else '' end) as prompt from benchmark, range(3) r(i) where i < 2 and trim(text) <> ''""")
def src12(spark, d):
    """Whole texts as prompts: even items have an object with items, odd ones a list; the third prompt is empty."""
    item = lambda prompt, description: F.struct(prompt.alias("prompt"), description.alias("description"))
    text, none = F.col("text"), F.lit("")
    listed = F.to_json(F.struct(F.array(item(F.concat(F.lit(" "), text), F.lit("x")), item(none, names.backwards(text)), item(none, none)).alias("items")))
    plain = F.to_json(F.array(text, names.capitals(text), F.lit("  ")))
    rows = parquet(spark, d, "benchmark").where(names.trimmed(text) != "").select("item_id", F.when(F.col("item_id") % 2 == 0, listed).otherwise(plain).alias("manifest"))
    return files.prompts(rows, F.col("manifest")).select("item_id", F.col("place").cast("int").alias("place"), "prompt")


@query("src16_summary_scan", "select l_returnflag as run_name, count(*)::bigint as runs, 'lineitem' as source from lineitem group by 1 union all select o_orderstatus, count(*)::bigint, 'orders' from orders group by 1")
def src16(spark, d):
    folder = files.scratch(spark)
    for name, run in (("lineitem", "l_returnflag"), ("orders", "o_orderstatus")):
        files.write_summary(parquet(spark, d, name).groupBy(F.col(run).alias("run_name")).agg(F.count(F.lit(1)).alias("runs")), f"{folder}/{name}/summary.csv")
    got = files.read_summaries(spark, f"{folder}/*/summary.csv", "run_name string, runs long")
    return got.select("run_name", "runs", F.element_at(F.split("source_path", "/"), -3).alias("source"))


@query("snk3_json_lines", "select n_nationkey, n_name, n_regionkey from nation")
def snk3(spark, d):
    rows, folder = parquet(spark, d, "nation"), f"{files.scratch(spark)}/rows"
    for part in (rows.where("n_nationkey % 2 = 0"), rows.where("n_nationkey % 2 = 1")):  # appended
        files.write_rows(part, folder)
    return files.read_rows(spark, folder, rows.schema)


@query("snk4_csv_rows", "select o_orderkey, o_orderstatus, o_orderpriority from orders")
def snk4(spark, d):
    rows, folder = parquet(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), f"{files.scratch(spark)}/rows.csv"
    files.write_summary(rows, folder)
    return files.read_summaries(spark, folder, rows.schema).drop("source_path")


@query("snk5_manifest", """select c_custkey, '{"customer":"' || c_name || '","nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}' as manifest from customer""")
def snk5(spark, d):
    return parquet(spark, d, "customer").select("c_custkey", files.manifest(F.col("c_name").alias("customer"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("manifest"))


@query("snk6_formatted", "select event_type, printf('%.3f', avg(value)) as mean_value from events group by event_type")
def snk6(spark, d):
    return parquet(spark, d, "events").groupBy("event_type").agg(files.formatted(F.avg("value")).alias("mean_value"))


@query("snk7_combined", "select s_name as name, s_acctbal as balance, null::varchar as segment from supplier union all select c_name, c_acctbal, c_mktsegment from customer")
def snk7(spark, d):
    a = parquet(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = parquet(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return reports.stacked([a, b])


@query("flt1_subset", "select doc_id, lang from documents where list_contains([lang, source], 'de') or contains(source, 'src1')")
def flt1(spark, d):
    return parquet(spark, d, "documents").where(filters.in_subset(F.array("lang", "source"), "de") | filters.in_subset(F.col("source"), "src1", False)).select("doc_id", "lang")


@query("flt2_status", "select event_id, value from events where event_type = 'view' and user_id % 2 = 0")
def flt2(spark, d):
    status, phase = F.when(F.col("event_type") == "view", "ok").otherwise("error"), F.when(F.col("user_id") % 2 == 0, "benchmark").otherwise("warm")
    return reports.finished(parquet(spark, d, "events"), status, phase).select("event_id", "value")


@query("flt3_duration_cap", "select event_id, case when event_id % 7 = 0 then 'ok' when value > 35 then 'skipped' else 'ok' end as status from events")
def flt3(spark, d):
    duration = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return parquet(spark, d, "events").select("event_id", filters.capped_status(duration, 35).alias("status"))


@query("flt5_cancelled", "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def flt5(spark, d):
    return parquet(spark, d, "orders").join(parquet(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


@query("flt6_finished_rows", "select p_partkey, p_size >= 16 as finished from part where p_size >= 16")
def flt6(spark, d):
    from ..operators import scheduling

    done, _ = scheduling.finished(parquet(spark, d, "part").select("p_partkey", F.col("p_size").alias("step_index"), F.lit(16).alias("steps")))
    return done.select("p_partkey", F.lit(True).alias("finished"))


@query("flt9_capability", "select p_partkey, case when p_size > 40 then 'too large' when p_type = 'ECONOMY' then 'no economy' end as reason from part")
def flt9(spark, d):
    return parquet(spark, d, "part").select("p_partkey", filters.unsupported({"too large": F.col("p_size") > 40, "no economy": F.col("p_type") == "ECONOMY"}).alias("reason"))


@query("flt10_key_exclusion", "select p_partkey, p_name from part where not regexp_matches(p_name, '^(red|blue)')")
def flt10(spark, d):
    return filters.none_left(filters.without_keys(parquet(spark, d, "part"), "p_name", "^(red|blue)"), "p_name", "^[a-z ]+$").select("p_partkey", "p_name")


@query("flt12_key_override", "select event_id, coalesce((props::json ->> 'k')::int, 0) as k, 5 as other from events")
def flt12(spark, d):
    base = F.create_map(F.lit("k"), F.lit(0), F.lit("other"), F.lit(5))
    given = F.map_concat(F.from_json("props", "map<string,int>"), F.create_map(F.lit("unknown"), F.lit(9)))
    got = filters.overridden(base, given)
    return parquet(spark, d, "events").select("event_id", F.element_at(got, "k").alias("k"), F.element_at(got, "other").alias("other"))


@query("flt14_validation", """
select p_partkey, case when p_size % 10 < 1 then 'bad steps' when p_size % 7 < 1 then 'bad candidates' when p_size % 5 < p_size % 7 then 'bad max_candidates' when p_size % 3 - 1 < 0 then 'bad margin' end as reason from part""")
def flt14(spark, d):
    size = F.col("p_size")
    rows = parquet(spark, d, "part").select("p_partkey", (size % 10).alias("steps"), (size % 7).alias("candidates"), (size % 5).alias("max_candidates"), (size % 3 - 1).alias("margin"))
    return rows.select("p_partkey", filters.setting_error().alias("reason"))


@query("flt15_failures", """
select event_id, case when event_type = 'error' and value > 20 then 'oom' when event_type = 'error' then 'error' else 'ok' end as status,
  case when event_type = 'error' and value > 20 then 'CUDA out of memory' when event_type = 'error' then 'ValueError: bad row ' || event_id end as reason from events""")
def flt15(spark, d):
    rows = parquet(spark, d, "events")
    message = F.when((F.col("event_type") == "error") & (F.col("value") > 20), "CUDA out of memory\nmore").when(F.col("event_type") == "error", F.concat(F.lit("bad row "), "event_id"))
    return rows.select("event_id", reports.classified(message).alias("status"), reports.failure_reason(F.lit("ValueError"), message).alias("reason"))


@query("set1_stacked", "select r_name as name from region union all select n_name from nation")
def set1(spark, d):
    return reports.stacked([parquet(spark, d, "region").select(F.col("r_name").alias("name")), parquet(spark, d, "nation").select(F.col("n_name").alias("name"))])


@query("set4_span_concat", """
select user_id, count(*) filter (event_type = 'click') + count(*) filter (event_type in ('click', 'view')) as spans,
  round(coalesce(sum(value) filter (event_type = 'click'), 0) + coalesce(sum(value) filter (event_type in ('click', 'view')), 0), 6) as total from events group by user_id""")
def set4(spark, d):
    value = lambda *kinds: F.collect_list(F.when(F.col("event_type").isin(*kinds), F.col("value")))
    lists = parquet(spark, d, "events").groupBy("user_id").agg(value("click").alias("a"), value("click", "view").alias("b"))
    both = segments.concatenated("a", "b")  # clicks are in both lists and stay twice
    return lists.select("user_id", F.size(both).cast("bigint").alias("spans"), F.round(F.aggregate(both, F.lit(0.0), lambda s, v: s + v), 6).alias("total"))


@query("set6_key_sets", """
select event_id, case when event_id % 2 = 0 then 'a,b' else 'a' end as missing,
  case when event_id % 3 = 0 then array_to_string(list_sort([event_type, 'k']), ',') when event_id % 2 = 0 then '' else 'k' end as unexpected from events""")
def set6(spark, d):
    own = F.map_keys(F.from_json("props", "map<string,int>"))  # each has the key k
    keys = F.when(F.col("event_id") % 3 == 0, F.concat(own, F.array("event_type"))).otherwise(own)
    even = F.col("event_id") % 2 == 0
    wanted = F.when(even & (F.col("event_id") % 3 != 0), F.array(*map(F.lit, "kab"))).when(even, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a")))
    got = filters.key_differences(keys, wanted)
    return parquet(spark, d, "events").select("event_id", F.array_join(got["missing"], ",").alias("missing"), F.array_join(got["unexpected"], ",").alias("unexpected"))


@query("fn9_short_hash", "select doc_id, substr(sha256(text), 1, 12) as short from documents")
def fn9(spark, d):
    return parquet(spark, d, "documents").select("doc_id", names.short_hash(F.col("text")).alias("short"))


@query("fn10_safe_stem", r"select page_id, regexp_replace(regexp_replace(list_last(string_split(url, '/')), '(.)\.[^.]*$', '\1'), '[^A-Za-z0-9_.-]', '_', 'g') as stem from pages")
def fn10(spark, d):
    return parquet(spark, d, "pages").select("page_id", names.safe_stem(F.col("url")).alias("stem"))


@query("fn14_run_name", "select p_partkey, case when p_size > 25 then p_brand || '-' || p_type else p_brand end as run_name from part")
def fn14(spark, d):
    return parquet(spark, d, "part").select("p_partkey", names.run_name(F.col("p_brand"), F.when(F.col("p_size") > 25, F.col("p_type")), F.lit("")).alias("run_name"))


@query("fn17_metric_names", "select n_nationkey, case n_nationkey % 3 when 0 then 'ContentEnjoyment' when 1 then 'ProductionQuality' else 'XX' end as metric from nation")
def fn17(spark, d):
    code = F.when(F.col("n_nationkey") % 3 == 0, "CE").when(F.col("n_nationkey") % 3 == 1, "PQ").otherwise("XX")
    return parquet(spark, d, "nation").select("n_nationkey", names.metric_name(code).alias("metric"))


@query("agg19_dedup_expand", "select doc_id, substr(sha256(text), 1, 12) as content, count(*) over (partition by text)::bigint as copies from documents")
def agg19(spark, d):
    docs = parquet(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_key"), "text")
    computed = reports.deduplicated(docs.drop("content_key"), F.col("text"))
    return docs.drop("text").join(computed, "content_key").select("doc_id", F.substring("content_key", 1, 12).alias("content"), "copies")


@query("agg18_counters", f"select event_type, count(*)::bigint as n, sum(case when value > 30 then 1 else 0 end)::bigint as slow from {E_SQL} group by event_type")
def agg18(spark, d):
    return events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 30).alias("slow"))
