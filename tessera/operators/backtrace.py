"""Backtrace of names through their sources to a document that defines them, and from there to a registry.

An entity has a list of source records. Round k takes the k-th source of every entity without a hit, so a round is a
handful of joins whatever the number of entities, and there are as many rounds as sources are tried. Each round's outcomes
are a written table: a rerun begins after the last whole one. The best status of an entity's rounds stays, the earlier of
equals. Work that repeats (one name in one document) is done once and joined back.

Judges by language models are not part of this program (its outcomes are those without a key); their answers can be
given as registry rows. Defined cases: an entity without sources is MISSING_SOURCE_RECORDINDEX; a source without a record
RAW_ROW_NOT_FOUND; a record without any candidate document MD_NOT_FOUND; null names and queries count as ''."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import gates, predicates, text
from tessera.operators import documents, steps
from tessera.operators.lookup import top_k
from tessera.operators.resolve import status_rank

#: Sources tried, tokens and windows that are searched for definitions, candidates that are asked for.
TRIES, TOKENS, WINDOWS, ASKED = 3, 8, 8, 5
SURE = ["doi", "filename", "filename_stem"]
FOUND = ["status", "doc_id", "method", "tried", "resolved", "cid", "formula", "confidence", "evidence"]


def record_candidates(records: DataFrame, catalog: DataFrame, folder: str) -> DataFrame:
    """(record, doc_id, method, tried) of the candidate documents of `records` (record, file, title, doi), numbered from 1 in their order. A record's
    candidates do not depend on who asks: they are found once and written under `folder`."""
    found = documents.placed_candidates(records, "record", "file", "title", "doi", catalog, f"{folder}/keys").withColumnRenamed("row", "record")
    order = top_k(found, [F.col("record")], [F.col("place")], 2**31 - 1)
    return steps.written(order.select("record", "doc_id", "method", F.col("rank").alias("tried")), f"{folder}/candidates")


def located(asked: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """(row, name, query, doc_id, method, tried, windows, matched) of each row's first candidate document that holds one of its tokens.

    `asked` has row, name, query, record; `found` record, doc_id, method, tried; `docs` doc_id, text. Documents that only a title or a
    likeness suggests need the name itself or a close form of it. Each name is sought once in each document."""
    met = asked.join(found, "record")
    pairs = met.select("name", "query", "doc_id").distinct()
    sought = asked.select("name", "query").distinct().withColumn("tokens", gates.search_tokens(F.col("name"), F.col("query")))
    texts = pairs.join(sought, ["name", "query"]).join(docs.select("doc_id", "text"), "doc_id")
    seen = texts.select("name", "query", "doc_id", gates.context_windows(F.coalesce("text", F.lit("")), F.col("tokens")).alias("w")).filter("size(w.matched) > 0")
    told = seen.select("name", "query", "doc_id", F.slice("w.windows", 1, WINDOWS).alias("windows"), "w.matched", gates.strong_hit(F.col("w.matched"), F.col("name")).alias("strong"))
    fits = met.join(told, ["name", "query", "doc_id"]).filter(F.col("method").isin(SURE) | F.col("strong"))
    best = fits.groupBy("row", "name", "query").agg(F.min_by(F.struct("doc_id", "method", "tried", "windows", "matched"), F.col("tried")).alias("x"))
    return best.select("row", "name", "query", "x.*")


def definitions(cases: DataFrame) -> DataFrame:
    """`cases` (case, name, windows, matched) to their candidate names: case, candidate, score, rule, evidence, at; class hints have candidate ''.

    Every token is tried in every window; a name counts once, with its best rule, at its first place."""
    each = cases.select("case", F.posexplode(F.slice("matched", 1, TOKENS)).alias("i", "token"), "windows")
    tried = each.select("case", "i", "token", F.posexplode("windows").alias("j", "window"))
    one = tried.select("token", "window").distinct()
    caught = one.select("token", "window", F.posexplode(gates.context_captures(F.col("token"), F.col("window"))).alias("k", "x"))
    hint = F.col("x.rule") == "class_hint"
    named = caught.select("token", "window", "k", "x.score", "x.rule", F.substring(text.norm_text_doc(F.col("x.evidence")), 1, 700).alias("evidence"), F.when(hint, "").otherwise(gates.captured_name(F.col("x.raw"))).alias("candidate"))
    good = named.filter((F.col("rule") == "class_hint") | ~predicates.is_bad_candidate(F.col("candidate")))
    every = tried.join(good, ["token", "window"])
    first = F.struct(-F.col("score"), "i", "j", "k")
    return every.groupBy("case", F.lower("candidate").alias("key")).agg(
        F.min_by(F.struct("candidate", "score", "rule", "evidence"), first).alias("x"), F.min(F.struct("i", "j", "k")).alias("at")
    ).select("case", "x.*", "at")


def asked_names(query: Column, known: Column) -> Column:
    """The keys under which a registry is asked for a query, in order: what abbreviations stand for, then the query."""
    core = text.core_name(query)
    keys = [F.element_at(known, F.upper(query)), F.element_at(known, F.upper(core)), query]
    return F.transform(F.filter(F.array(*keys), lambda x: x.isNotNull() & (x != "")), lambda x: F.lower(x))


def resolved(cases: DataFrame, registry: DataFrame, known: dict[str, str], folder: str) -> DataFrame:
    """(case, status, resolved, cid, formula, confidence, evidence) of `cases` (case, name, query, windows, matched).

    Of the five best candidates, in order: one that is not trusted is passed over; a class of materials, or a name that no
    registry would know, classifies; one that the registry knows is the hit; others are names without a hit."""
    abbreviation = predicates.looks_like_abbreviation(F.col("name"))
    base = cases.withColumns({"is_abbr": abbreviation, "material": predicates.mentions_material(F.concat_ws(" ", "name", "query", F.array_join(F.slice("windows", 1, 3), " ")))})
    every = steps.written(definitions(base), f"{folder}/definitions")
    hints = every.filter("candidate = ''").select("case", F.struct(F.col("score").alias("confidence"), "evidence").alias("hint"))
    ranked = every.filter("candidate <> ''").join(base.select("case", "is_abbr"), "case").filter(~F.col("is_abbr") | gates.is_trusted_expansion(F.col("candidate")))
    five = top_k(ranked, [F.col("case")], [F.desc("score"), F.col("at")], ASKED)
    gated = steps.written(five.withColumn("gate", gates.aligned(F.col("candidate"), F.col("is_abbr"))), f"{folder}/gated")
    judged = gated.filter("gate.accepted").withColumn("clean", F.col("gate.clean_name"))
    classed = predicates.mentions_material(F.col("clean")) | predicates.mentions_material(F.col("evidence")) | ~gates.worth_asking(F.col("clean"))
    sorted_out = steps.written(judged.withColumns({"class": classed, "sure": F.greatest("score", F.col("gate.confidence"))}).drop("gate"), f"{folder}/judged")
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv]) if known else F.lit(None).cast("map<string,string>")
    keys = sorted_out.filter("not class").select("clean").distinct().select("clean", F.posexplode(asked_names(F.col("clean"), table)).alias("n", "name_key"))
    hit = keys.join(registry.select("name_key", "cid", "formula"), "name_key").groupBy("clean").agg(F.min_by(F.struct("cid", "formula"), "n").alias("hit"))
    outcome = F.when(F.col("class"), "BACKTRACE_CLASSIFIED").when(F.col("hit").isNotNull(), "BACKTRACE_HIT").when(F.col("is_abbr"), "BACKTRACE_NAME_OK").otherwise("EXPANSION_FOUND_BUT_PUBCHEM_NO_HIT")
    told = sorted_out.join(hit, "clean", "left").select("case", "rank", F.struct(outcome.alias("status"), F.col("clean").alias("resolved"), F.col("hit.cid").alias("cid"), F.col("hit.formula").alias("formula"), F.col("sure").alias("confidence"), "evidence").alias("x"))
    lists = told.groupBy("case").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "x"))), lambda r: r["x"]).alias("xs"))  # five at most
    any_ranked = ranked.select("case").distinct().withColumn("ranked", F.lit(True))

    def later(best: Column, x: Column) -> Column:
        no_hit = x["status"].isin("BACKTRACE_NAME_OK", "EXPANSION_FOUND_BUT_PUBCHEM_NO_HIT")
        better = best.isNull() | (status_rank(x["status"]) > status_rank(best["status"]))
        return F.when(F.coalesce(best["status"] == "BACKTRACE_HIT", F.lit(False)), best).when(no_hit | better, x).otherwise(best)

    kind = "struct<status:string,resolved:string,cid:string,formula:string,confidence:double,evidence:string>"
    typed = lists.withColumn("xs", F.col("xs").cast(f"array<{kind}>"))
    best = typed.select("case", F.aggregate("xs", F.lit(None).cast(kind), later).alias("best"))
    out = base.join(best, "case", "left").join(hints, "case", "left").join(any_ranked, "case", "left")
    b, first = F.col("best"), F.substring(F.coalesce(F.get("windows", 0), F.lit("")), 1, 700)
    none = F.lit(None).cast("string")
    as_kind = lambda status, x, confidence, evidence: F.struct(
        F.lit(status).alias("status"), x["resolved"].alias("resolved"), x["cid"].alias("cid"), x["formula"].alias("formula"), confidence.alias("confidence"), evidence.alias("evidence")
    )
    nothing = F.struct(F.lit("").alias("resolved"), none.alias("cid"), none.alias("formula"))
    final = (
        F.when(F.col("material") & F.col("ranked").isNull(), as_kind("BACKTRACE_CLASSIFIED", nothing, F.lit(0.0), first))
        .when(b["status"] == "BACKTRACE_HIT", b)
        .when(F.col("hint").isNotNull(), as_kind("BACKTRACE_CLASSIFIED", F.coalesce(b, F.struct(none.alias("status"), F.lit("").alias("resolved"), none.alias("cid"), none.alias("formula"), F.lit(0.0).alias("confidence"), none.alias("evidence")).cast(kind)), F.col("hint.confidence"), F.col("hint.evidence")))
        .when(b.isNotNull(), b)
        .otherwise(as_kind("CONTEXT_FOUND_BUT_NO_EXPANSION", nothing, F.lit(0.0), first))
    )
    return out.select("case", final.alias("f")).select("case", "f.*")


def trace_source(asked: DataFrame, docs: DataFrame, found: DataFrame, registry: DataFrame, known: dict[str, str], folder: str) -> DataFrame:
    """`asked` (row, name, query, record; record is null where there is none) to row and the columns of FOUND. `found` is what
    record_candidates gives. Steps that are read again are written under `folder`."""
    here = asked.select("row", "record", *[text.norm_text_doc(F.col(c)).alias(c) for c in ("name", "query")])
    placed = steps.written(located(here.filter("record is not null"), found, docs), f"{folder}/located")
    cases = placed.withColumn("case", F.struct("name", "query", "doc_id"))
    distinct = cases.groupBy("case").agg(F.first("windows").alias("windows"), F.first("matched").alias("matched")).select("case", "case.name", "case.query", "windows", "matched")
    told = resolved(distinct, registry, known, folder)
    outcome = cases.select("row", "case", "doc_id", "method", "tried").join(told, "case").select("row", *FOUND)
    counted = found.groupBy("record").agg(F.max("tried").alias("tried"))
    rest = here.join(placed.select("row"), "row", "left_anti").join(counted, "record", "left")
    status = F.when(F.col("record").isNull(), "RAW_ROW_NOT_FOUND").when(F.col("tried").isNull(), "MD_NOT_FOUND").otherwise("TOKEN_NOT_IN_MD")
    kinds = dict(outcome.dtypes)
    missing = {"status": status, "tried": F.coalesce("tried", F.lit(0)), "resolved": F.lit(""), "confidence": F.lit(0.0), "evidence": F.lit("")}
    return outcome.unionByName(rest.select("row", *[missing.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in FOUND]))


def backtrace(entities: DataFrame, records: DataFrame, docs: DataFrame, catalog: DataFrame, registry: DataFrame, known: dict[str, str], folder: str, tries: int = TRIES) -> DataFrame:
    """`entities` (entity, name, query, sources: array of records) to entity, source, trail and the columns of FOUND.

    `folder` holds the rounds; a call with the folder of one that was stopped goes on after its last whole round."""
    spark = entities.sparkSession
    first = entities.select("entity", "name", "query", F.slice(F.coalesce("sources", F.array().cast(entities.schema["sources"].dataType)), 1, max(1, tries)).alias("sources"))
    cited = records.join(first.select(F.explode("sources").alias("record")).distinct(), "record", "left_semi")
    found = record_candidates(cited, catalog, folder)
    numbers = records.select(F.col("record").alias("source"), "record")
    rounds: list[DataFrame] = []
    for k in range(1, max(1, tries) + 1):
        here = f"{folder}/round-{k}"
        if steps.is_whole(spark, f"{here}/outcome"):
            rounds.append(spark.read.parquet(f"{here}/outcome"))
            continue
        steps.remove(spark, here)
        open_ = first.filter(F.size("sources") >= k).select("entity", "name", "query", F.get("sources", k - 1).alias("source"))
        for before in rounds:
            open_ = open_.join(before.filter("status = 'BACKTRACE_HIT'").select("entity"), "entity", "left_anti")
        asked = steps.written(open_.join(numbers, "source", "left").withColumnRenamed("entity", "row"), f"{here}/asked")
        told = trace_source(asked, docs, found, registry, known, here).withColumnRenamed("row", "entity")
        rounds.append(steps.written(told.join(asked.select(F.col("row").alias("entity"), "source"), "entity"), f"{here}/outcome"))
    every = None
    for k, told in enumerate(rounds, 1):
        one = told.withColumn("round", F.lit(k))
        every = one if every is None else every.unionByName(one)
    better = F.struct(status_rank(F.col("status")), -F.col("round"))
    best = every.groupBy("entity").agg(
        F.max_by(F.struct("source", *FOUND), better).alias("x"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("round", F.concat(F.col("source").cast("string"), F.lit(":"), "status").alias("said")))), lambda r: r["said"]), "|").alias("trail"),
    )
    out = first.select("entity", "name", "query").join(best, "entity", "left")
    none = F.struct(F.lit(None).cast(entities.schema["sources"].dataType.elementType).alias("source"), *[F.lit("MISSING_SOURCE_RECORDINDEX" if c == "status" else None).cast(every.schema[c].dataType).alias(c) for c in FOUND])
    return out.withColumn("x", F.coalesce("x", none)).select("entity", "name", "query", "x.*", F.coalesce("trail", F.lit("")).alias("trail"))


#: Columns that the delivered tables take from a trace, beside those of the entities.
EVIDENCE = ["source", "doc_id", "method", "tried", "resolved", "confidence", "evidence", "trail"]


def final_main(entities: DataFrame, merged: DataFrame) -> DataFrame:
    """The entities' own columns, as merged, and the source that matched."""
    return merged.select(*entities.columns, "matched_source")


def evidence(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, then where and how an entity was traced, then what the trace found."""
    return merged.select(*keys, *[c for c in EVIDENCE if c in merged.columns], *[c for c in merged.columns if c.startswith("bt_")])


def outputs(entities: DataFrame, merged: DataFrame, traced: DataFrame, keys: list[str], review: list[str]) -> dict[str, DataFrame]:
    """The five delivered tables: final_main, review_needed (statuses of `review`), evidence, bt_all, abbr_dict_candidates."""
    named = traced.filter(F.coalesce("resolved", F.lit("")) != "")
    return {
        "final_main": final_main(entities, merged),
        "review_needed": merged.filter(F.col("bt_status").isin(review)).select(*entities.columns, "matched_source", "bt_status", "resolved", "trail"),
        "evidence": evidence(merged, keys),
        "bt_all": traced,
        "abbr_dict_candidates": named.select("name", "resolved", "status", "confidence", F.col("evidence")).distinct(),
    }


def write_outputs(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}")
