"""Queries of run control, of model answers, and of what a reader sees of an entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import control, dossiers
from .registry import Tables, plain, query

#: Events as tasks. Needs form a forest with second needs; two neighbours of a hundred or so need each other.
TASKS = "select event_id as task, event_type <> 'error' as ok from {events}"
NEEDS = """select event_id as task, cast(floor(event_id / 7) as bigint) as needs from {events} where event_id % 3 <> 0 and event_id % 97 > 1 and event_id >= 7
    union all select event_id, event_id - 5 from {events} where event_id % 10 = 5 and event_id % 97 > 1
    union all select event_id, event_id + 1 - 2 * (event_id % 97) from {events} where event_id % 97 <= 1"""


@query("R6_R6a_W12_task_states", f"""
    with recursive t as ({plain(TASKS)}), e as (select distinct task, needs from ({plain(NEEDS)}) where needs in (select task from t)),
    anc(task, a) as (select task, needs from e union select anc.task, e.needs from anc join e on anc.a = e.task),
    looped as (select task from anc where task = a), stuck as (select task from looped union select task from anc where a in (select task from looped)),
    doomed as (select distinct anc.task from anc join t p on p.task = anc.a where not p.ok and p.task not in (select task from stuck)),
    lvl(task, w) as (select task, 0 from t where task not in (select task from stuck) and task not in (select task from e)
        union select e.task, w + 1 from lvl join e on e.needs = lvl.task where e.task not in (select task from stuck)),
    waves as (select task, max(w) as w from lvl group by task)
    select t.task, case when d.task is not null or s.task is not null then 'skipped' when ok then 'completed' else 'failed' end as state,
        case when d.task is not null then 'dependency-failed' when s.task is not null then 'unsatisfiable dependencies' end as reason,
        case when d.task is null and s.task is null then w end::int as wave
    from t left join doomed d on d.task = t.task left join stuck s on s.task = t.task left join waves on waves.task = t.task""")
def task_states(t: Tables) -> DataFrame:
    return control.settle(t.sql(TASKS), t.sql(NEEDS))


@query("R3a_skipped_prerequisites", f"""select task, count(*)::bigint as waits_for from (select distinct task, needs from ({plain(NEEDS)})) n join events on event_id = needs where event_type <> 'click' group by task""")
def skipped_prerequisites(t: Tables) -> DataFrame:
    known = t.events.select(F.col("event_id").alias("needs"))
    done = t.events.where("event_type = 'click'").select(F.col("event_id").alias("task"))
    left = control.remaining_needs(t.sql(NEEDS).distinct().join(known, "needs", "left_semi"), done)
    return left.groupBy("task").agg(F.count("*").alias("waits_for"))


@query("F90_L1d_completions", """select event_id, case event_id % 6 when 0 then 'said ' || event_type when 1 then 'ab' else '' end as text, case event_id % 6 when 0 then event_id when 5 then 7 else 0 end::bigint as prompt,
    case event_id % 6 when 0 then 5 else 0 end::bigint as completion, case event_id % 6 when 0 then 3 when 1 then 4 else 0 end::bigint as cached, case event_id % 6 when 0 then 2 else 0 end::bigint as reasoning,
    case event_id % 6 when 0 then event_id + 5 when 1 then 99 when 5 then 7 else 0 end::bigint as total, case event_id % 6 when 0 then 'stop' when 1 then 'length' else 'unknown' end as finish,
    case event_id % 6 when 1 then 'response_format' end as failure from events""")
def completions(t: Tables) -> DataFrame:
    n = F.col("event_id")
    raw = (
        F.when(n % 6 == 0, F.concat(F.lit('{"model":"m","choices":[{"finish_reason":"stop","message":{"content":"said '), "event_type", F.lit('"}}],"usage":{"prompt_tokens":'), n.cast("string"),
               F.lit(',"completion_tokens":5,"prompt_tokens_details":{"cached_tokens":3},"completion_tokens_details":{"reasoning_tokens":2}}}')))
        .when(n % 6 == 1, '{"choices":[{"finish_reason":"length","message":{"content":[{"type":"text","text":"a"},{"type":"image"},{"text":"b"}]}}],"usage":{"total_tokens":99,"cache_read_input_tokens":4}}')
        .when(n % 6 == 2, '{"choices":[{"finish_reason":"eos","message":{"content":null}}]}').when(n % 6 == 3, "{}").when(n % 6 == 4, "not json").otherwise('{"choices":[],"usage":{"prompt_tokens":7}}')
    )
    return t.events.select("event_id", raw.alias("raw")).select("event_id", *[c.alias(k) for k, c in control.read_completion(F.col("raw")).items()])


@query("S14_run_ids", "select event_id, strftime(ts, '%Y%m%d-%H%M%S') || '-' || md5(event_id::varchar)[:4] as run from events")
def run_ids(t: Tables) -> DataFrame:
    return t.events.select("event_id", control.run_id(F.col("ts"), F.col("event_id")).alias("run"))


@query("V6_row_members", """select c_custkey, case c_custkey % 5 when 0 then 'born' when 1 then 'forename,surname' when 4 then 'died,dates' end as members from customer where c_custkey % 5 not in (2, 3)""")
def row_members(t: Tables) -> DataFrame:
    """Index rows that carry what belongs to the dossier."""
    k = F.col("c_custkey") % 5
    raw = F.when(k == 0, '{"id":"1","born":"x"}').when(k == 1, '{"surname":"s","forename":null}').when(k == 2, '{"id":3}').when(k == 3, "[]").otherwise('{"dates":{},"died":1}')
    found = t.customer.select("c_custkey", control.members_present(raw, ("born", "died", "dates", "forename", "surname")).alias("m")).where(F.size("m") > 0)
    return found.select("c_custkey", F.array_join("m", ",").alias("members"))


@query("M6f_M6g_items", """select p_partkey, case when p_partkey % 3 = 0 then 'A ' || p_name || '|C|D' else '' end as labels, case when p_partkey % 3 = 0 then 'a' || p_partkey || '.jpg|embedded|d.pdf' else '' end as targets,
    case when p_partkey % 3 = 0 then 'w=1;;x=y' else '' end as rest, case when p_partkey % 3 = 0 then 2 else 0 end as dropped from part""")
def items(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    listed = F.concat(F.lit('[{"label":"A '), "p_name", F.lit('","target":"en/a'), k.cast("string"), F.lit('.jpg","w":1},{"label":"B","target":"a'), k.cast("string"),
                      F.lit('.jpg"},{"label":" ","target":"t"},5,{"label":"C","target":"Embedded"},{"label":"D","target":"d.pdf","note":null,"x":"y"}]'))
    raw = F.when(k % 3 == 0, listed).when(k % 3 == 1, "{}")
    got = t.part.select("p_partkey", dossiers.sanitized_items(raw).alias("s"))
    rest = F.transform("s.items", lambda x: F.array_join(F.transform(x["rest"], lambda e: F.concat_ws("=", e["key"], e["value"])), ","))
    return got.select("p_partkey", F.array_join(F.transform("s.items", lambda x: x["label"]), "|").alias("labels"), F.array_join(F.transform("s.items", lambda x: x["target"]), "|").alias("targets"),
                      F.array_join(rest, ";").alias("rest"), F.col("s.dropped").alias("dropped"))


@query("L9_extraction_plan", """select c_custkey, case when c_custkey % 3 = 0 then 'create' else 'reuse' end as reuse, case when c_custkey % 3 = 0 then 'create' when c_custkey % 2 = 0 then 'nothing-left' else 'complete' end as complete,
    case when c_custkey % 3 = 0 then 'create' else 'rebuild' end as rebuild from customer""")
def extraction_plan(t: Tables) -> DataFrame:
    exists = F.col("c_custkey") % 3 != 0
    missing = F.when(F.col("c_custkey") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("born")))
    return t.customer.select("c_custkey", *[dossiers.extraction_plan(exists, p, missing).alias(p) for p in ("reuse", "complete", "rebuild")])


READERS = """select c_custkey, c_name, case c_custkey % 3 when 0 then array('ru', 'en') when 1 then array('es') else array('en', 'de', 'ru') end as langs, case c_custkey % 2 when 0 then 'en' else 'de' end as ui,
    case c_custkey % 4 when 0 then '' when 1 then '//cdn.org/a.md' when 2 then '/a' || cast(c_custkey as string) || '.md' else 'a.md' end as md, case c_custkey % 5 when 0 then null else '/d.json' end as json,
    case c_custkey % 6 when 0 then 'i.jpg' else null end as img, case c_custkey % 7 when 0 then 'm' when 1 then 'f' when 2 then 'mixed' else null end as gender from {customer}"""


@query("Q3_Q4_Q10_Q12_reading", f"""
    with r as (select *, case when list_contains(langs, ui) then ui else langs[1] end as edition from ({plain(READERS).replace("array(", "list_value(")})),
    p as (select *, case c_custkey % 4 when 0 then '' when 1 then '//cdn.org/a.md' when 2 then '/' || edition || '/a' || c_custkey || '.md' else '/' || edition || '/a.md' end as local from r)
    select c_custkey, edition, case when c_custkey % 4 in (0, 1) then local else '/fable' || local end as article, case when json is null then 'page' else 'biography' end as kind,
        coalesce(img, 'photos/default-' || case gender when 'm' then 'male' when 'f' then 'female' else 'mixed' end || '.svg') as portrait, 'C' as letters from p""")
def reading(t: Tables) -> DataFrame:
    c = F.col
    r = t.sql(READERS).withColumn("edition", dossiers.edition(c("langs"), c("ui")))
    return r.select("c_custkey", "edition", dossiers.catalogue_path(dossiers.localized_path(c("md"), c("edition")), "/fable").alias("article"), dossiers.entry_kind(c("json")).alias("kind"),
                    dossiers.portrait(c("img"), c("gender")).alias("portrait"), dossiers.monogram(c("c_custkey").cast("string"), c("c_name"))["letters"].alias("letters"))


@query("S11_source_dossiers", """
    select c_custkey as item, case when c_custkey % 4 = 0 then 'output' when c_custkey % 3 = 0 then 'source' end as origin,
        case when c_custkey % 4 = 0 then sha256('{"o": ' || c_custkey || '}')[:12] when c_custkey % 3 = 0 then sha256('{"s": ' || c_custkey || '}')[:12] end as hash from customer""")
def source_dossiers(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    items = t.customer.select(k.alias("item"))
    output = t.customer.where(k % 2 == 0).select(k.alias("item"), F.when(k % 4 == 0, F.concat(F.lit('{"o": '), k.cast("string"), F.lit("}"))).otherwise("{bad").alias("raw"))
    authored = t.customer.where(k % 3 == 0).select(k.alias("item"), F.concat(F.lit('{"s": '), k.cast("string"), F.lit("}")).alias("raw"))
    return dossiers.source_dossier(items, output, authored)
