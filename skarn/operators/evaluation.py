"""Retrieval and answer evaluation: evidence matches with line ranges, recall and precision at k, citations, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

REFUSAL = "unanswerable_missing_evidence"


def ranked(preds: DataFrame, k: int) -> DataFrame:
    """Predicted evidence rows with a rank of at most k; without one their position counts."""
    return preds.withColumn("rank", F.coalesce("rank", F.col("position"))).where(F.col("rank") <= k)


def same_place(a: Column, b: Column) -> Column:
    """Whether two items name the same source or the same path; empty names match nothing."""

    def same(field: str) -> Column:
        return F.coalesce((a[field] == b[field]) & (a[field] != ""), F.lit(False))

    return same("source_id") | same("path")


def lines_match(gold: Column, pred: Column, lenient: bool = False) -> Column:
    """Gold without a range matches anything; a prediction without one matches nothing, or anything if ``lenient``."""
    return F.when(gold["range"].isNull(), True).when(pred["range"].isNull(), lenient).otherwise(S.overlap(gold["range"], pred["range"]))


def score_retrieval(cases: DataFrame, gold: DataFrame, refs: DataFrame, preds: DataFrame, k: int = 10, lenient: bool = False) -> DataFrame:
    """Recall, precision and F1 at k for every case.

    ``gold`` (case_id, evidence_id, source_id, path, lines), ``refs`` (case_id, source_id, path), ``preds`` (case_id, position, rank,
    source_id, path, lines). A case's items meet as arrays, so each table is shuffled once; repeated items count each.
    """
    place = lambda *more: F.struct(F.col("source_id"), F.col("path"), *more)
    span = S.line_range(F.col("lines")).alias("range")
    g = gold.groupBy("case_id").agg(F.collect_list(place(F.col("evidence_id"), span)).alias("gold"))
    r = refs.groupBy("case_id").agg(F.collect_list(place()).alias("refs"))
    p = ranked(preds, k).groupBy("case_id").agg(F.collect_list(place(span)).alias("preds"))
    every = cases.select("case_id", "answerability").join(g, "case_id", "left").join(r, "case_id", "left").join(p, "case_id", "left")
    hit = F.filter("gold", lambda x: F.exists("preds", lambda y: same_place(x, y) & lines_match(x, y, lenient)))
    hit_preds = F.filter("preds", lambda y: F.exists("gold", lambda x: same_place(x, y) & lines_match(x, y, lenient)))
    hit_refs = F.filter("refs", lambda x: F.exists("preds", lambda y: same_place(x, y)))
    count = lambda c: F.coalesce(F.size(c), F.lit(0))
    every = every.withColumns({"hit": hit, "n_gold": count("gold"), "n_refs": count("refs"), "n_preds": count("preds"), "matched_preds": count(hit_preds), "matched_refs": count(hit_refs)})
    free = F.when((F.col("answerability") == REFUSAL) & (F.col("n_gold") == 0) & (F.col("n_refs") == 0), 1.0).otherwise(0.0)
    share = lambda a, n: F.when(F.col(n) > 0, a / F.greatest(F.col(n), F.lit(1))).otherwise(free)
    ids = F.array_join(F.array_sort(F.transform("hit", lambda x: x["evidence_id"])), ",")
    out = every.select(
        "case_id",
        share(F.col("matched_refs"), "n_refs").alias("reference_recall"),
        share(count("hit"), "n_gold").alias("evidence_recall"),
        share(F.col("matched_preds"), "n_preds").alias("evidence_precision"),
        F.coalesce(ids, F.lit("")).alias("matched_ids"),
        F.col("n_preds").cast("long").alias("n_preds"),
    )
    both = F.col("evidence_recall") + F.col("evidence_precision")
    return out.withColumn("evidence_f1", F.when(both > 0, 2 * F.col("evidence_recall") * F.col("evidence_precision") / F.greatest(both, F.lit(1e-12))).otherwise(0.0))


def _rate(c: Column) -> Column:
    return F.coalesce(F.avg(c.cast("int")), F.lit(0.0))


def _mean(c) -> Column:
    return F.coalesce(F.avg(c), F.lit(0.0))


def summary(scores: DataFrame) -> DataFrame:
    """One row: pass rate and means; 0 where there is no case."""
    return scores.agg(F.count(F.lit(1)).alias("cases"), _rate(F.col("evidence_recall") >= 1).alias("retrieval_pass"), *[_mean(c).alias(f"mean_{c}") for c in ("reference_recall", "evidence_recall", "evidence_precision", "evidence_f1")])


def strict(results: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Adds retrieval_pass, answer_pass and strict_pass to (evidence_recall, citation_pass, score, verdict): all gold
    found, the answer judged correct with enough score, and the citations in order."""
    retrieval = F.col("evidence_recall") == 1.0
    answer = F.coalesce((F.col("score") >= threshold) & (F.col("verdict") == "correct"), F.lit(False))
    return results.withColumns({"retrieval_pass": retrieval, "answer_pass": answer, "strict_pass": retrieval & answer & F.col("citation_pass")})


_MEASURES = ("reference_recall", "evidence_recall", "evidence_precision", "evidence_f1")


def full_summary(results: DataFrame) -> DataFrame:
    """One row over strict results (with ``missing`` and ``total_tokens``): rates, means, and coverage of judge and tokens."""
    return results.agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if("missing").alias("missing_predictions"),
        *[_rate(F.col(c)).alias(f"{c}_rate") for c in ("retrieval_pass", "strict_pass", "answer_pass", "citation_pass")],
        *[_mean(c).alias(f"mean_{c}") for c in _MEASURES],
        _rate(F.col("score").isNotNull()).alias("judge_coverage"),
        _mean("score").alias("mean_score"),
        _rate(F.col("total_tokens").isNotNull()).alias("token_coverage"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("sum_total_tokens"),
        _mean("total_tokens").alias("mean_total_tokens"),
    )


def slices(scores: DataFrame, dimensions: list[str], measures: dict[str, Column] | None = None) -> DataFrame:
    """(dimension, value, cases, measures...) over each dimension by itself, in one pass."""
    own = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("unknown")).alias("value")) for d in dimensions])
    measures = measures or {"pass_rate": F.avg((F.col("evidence_recall") >= 1).cast("int")), "mean_recall": F.avg("evidence_recall")}
    kept = scores.drop(*[d for d in dimensions if d in ("dimension", "value")])
    return kept.withColumn("__s", F.explode(own)).groupBy("__s.dimension", "__s.value").agg(F.count(F.lit(1)).alias("cases"), *[m.alias(n) for n, m in measures.items()])


def slice_measures() -> dict[str, Column]:
    """The measures of ``slices`` over strict results."""
    return {
        "strict_pass_rate": _rate(F.col("strict_pass")),
        "retrieval_pass_rate": _rate(F.col("retrieval_pass")),
        "mean_evidence_recall": _mean("evidence_recall"),
        "mean_score": _mean("score"),
        "mean_total_tokens": _mean("total_tokens"),
        "token_coverage": _rate(F.col("total_tokens").isNotNull()),
    }


def verdict_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def error_counts(results: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent judge errors, secrets redacted; ties by text."""
    own = results.where("error <> ''").select(S.redacted(F.col("error")).alias("error"))
    return own.groupBy("error").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error").limit(most)


def first_predictions(preds: DataFrame, cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, problems): each case's first prediction by ``line``; and (case_id, line, problem) of repeated and unknown ones."""
    nth = F.row_number().over(Window.partitionBy("case_id").orderBy("line"))
    numbered = preds.withColumn("__nth", nth)
    again = numbered.where("__nth > 1").select("case_id", "line", F.lit("duplicate").alias("problem"))
    unknown = preds.join(cases.select("case_id"), "case_id", "left_anti").select("case_id", "line", F.lit("unknown").alias("problem"))
    return numbered.where("__nth = 1").drop("__nth"), again.unionByName(unknown)


#: What makes a question ask for evidence (fixed values).
CITATION_TRIGGERS = ("证据", "代码证据", "行号", "片段", "引用", "cite", "citation", "line", "proof")


def asks_for_citation(query: Column) -> Column:
    out, low = F.lit(False), F.lower(query)
    for trigger in CITATION_TRIGGERS:
        out = out | low.contains(trigger)
    return out


def citation_pass(cases: DataFrame, evidence: DataFrame, exact: bool = False) -> DataFrame:
    """(case_id, citation_pass): the answer cites every item that its case's policy asks for.

    ``cases`` (case_id, query, answer, required, granularity, required_ids), ``evidence`` (case_id, evidence_id, source_id, path,
    lines). Unless ``exact``, a missing ``required`` means always and a citation may overlap the lines; if ``exact`` it means
    when the query asks for evidence, and path:lines must stand in the answer to the letter. A case that must cite fails
    without an item.
    """
    items = evidence.groupBy("case_id").agg(F.collect_list(F.struct("evidence_id", "source_id", "path", "lines")).alias("items"))
    both = cases.join(items, "case_id", "left")
    wanted = F.coalesce("required_ids", F.array().cast("array<string>"))
    chosen = F.filter("items", lambda x: (F.size(wanted) == 0) | F.array_contains(wanted, x["evidence_id"]))
    answer = F.coalesce("answer", F.lit(""))
    both = both.withColumns({"chosen": chosen, "cited": S.citations(answer)})
    named = lambda name: (F.coalesce(name, F.lit("")) != "") & answer.contains(name)
    bare = lambda x: F.coalesce(x["lines"], F.lit("")) == ""

    def placed(x: Column) -> Column:
        if exact:
            return F.when(bare(x), answer.contains(x["path"])).otherwise(answer.contains(F.concat(x["path"], F.lit(":"), x["lines"])))
        hit = F.exists("cited", lambda c: (c["path"] == x["path"]) & F.coalesce(S.overlap(S.line_range(c["lines"]), S.line_range(x["lines"])), F.lit(False)))
        return F.when(bare(x), named(x["path"])).otherwise(hit)

    grain = F.coalesce("granularity", F.lit("path_line"))
    ok = F.forall("chosen", lambda x: F.coalesce(F.when(grain == "source_only", named(x["source_id"]) | named(x["path"])).when(grain == "path_only", named(x["path"])).otherwise(placed(x)), F.lit(False)))
    policy = F.coalesce("required", F.lit("when_query_requests_evidence" if exact else "always"))
    must = (policy == "always") | ((policy == "when_query_requests_evidence") & asks_for_citation(F.col("query"))) if exact else policy != "never"
    return both.select("case_id", (~must | (F.coalesce(F.size("chosen"), F.lit(0)) > 0) & F.coalesce(ok, F.lit(False))).alias("citation_pass"))


def atom_coverage(atoms: DataFrame, answers: DataFrame, threshold: float = 0.35, forbidden_threshold: float = 0.65) -> DataFrame:
    """(case_id, coverage, conclusion_ok, fatal): weighted share of matched required atoms; whether there are conclusions
    and all match; whether a fatal forbidden atom matches.

    ``atoms`` (case_id, atom_id, role, statement, weight, forbidden, severity); a weight that is not positive counts 1 and a
    missing severity is fatal.
    """
    hit = F.when(F.col("forbidden"), S.lexical_match(F.col("statement"), F.col("answer"), forbidden_threshold)).otherwise(S.lexical_match(F.col("statement"), F.col("answer"), threshold))
    both = atoms.join(answers, "case_id").withColumn("hit", F.coalesce(hit, F.lit(False)))
    need = ~F.col("forbidden")
    weight = F.when(need, F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0)).otherwise(0.0)
    return both.groupBy("case_id").agg(
        F.coalesce(F.sum(F.when(F.col("hit"), weight).otherwise(0.0)) / F.nullif(F.sum(weight), F.lit(0.0)), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.every(F.when(need & (F.col("role") == "conclusion"), F.col("hit"))), F.lit(False)).alias("conclusion_ok"),
        F.coalesce(F.some(F.col("forbidden") & F.col("hit") & (F.coalesce("severity", F.lit("fatal")) == "fatal")), F.lit(False)).alias("fatal"),
    )


def case_verdict(scored: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Adds verdict to (evidence_recall, coverage, conclusion_ok, fatal, citation_pass): PASS if all gold is found, the
    conclusions match with enough coverage, nothing fatal does and the citations hold; FAIL without recall or with a fatal atom."""
    answer = F.col("conclusion_ok") & (F.col("coverage") >= threshold) & ~F.col("fatal")
    passed = (F.col("evidence_recall") == 1.0) & answer & F.col("citation_pass")
    return scored.withColumn("verdict", F.when(passed, "PASS").when((F.col("evidence_recall") == 0) | F.col("fatal"), "FAIL").otherwise("WARN"))


def token_totals(usage: DataFrame, by: list[str]) -> DataFrame:
    """(by..., events, covered, total_tokens, mean_tokens): sums over present values, the latest event of each case counting."""
    total = F.coalesce("total_tokens", F.col("input_tokens") + F.col("output_tokens"))
    return usage.withColumn("total", total).groupBy(*by).agg(F.count(F.lit(1)).alias("events"), F.count("total").alias("covered"), F.coalesce(F.sum("total"), F.lit(0)).alias("total_tokens"), F.coalesce(F.avg("total"), F.lit(0.0)).alias("mean_tokens"))


def latest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last event of each key by the order columns."""
    rest = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("e")).select(key, "e.*")


def adversarial(outcomes: DataFrame, cases: DataFrame, required: DataFrame) -> DataFrame:
    """(case_id, passed, reason, untested) for all ``cases``.

    ``outcomes`` (case_id, attribute, baseline, outcome), ``required`` (case_id, attribute, baseline). An attribute is confirmed
    if all its baselines failed; a case passes if any of its attributes is and no required pair is untested, and without
    attributes.
    """
    own = required.select("case_id", "attribute").distinct().withColumn("declared", F.lit(True))
    per = outcomes.groupBy("case_id", "attribute").agg(F.every(F.col("outcome") == "baseline_failed").alias("confirmed"))
    tested = own.join(per, ["case_id", "attribute"], "left").groupBy("case_id").agg(F.some(F.coalesce("confirmed", F.lit(False))).alias("any_confirmed"))
    missing = required.distinct().join(outcomes.select("case_id", "attribute", "baseline").distinct(), ["case_id", "attribute", "baseline"], "left_anti").groupBy("case_id").agg(F.count(F.lit(1)).alias("untested"))
    every = cases.select("case_id").distinct().join(tested, "case_id", "left").join(missing, "case_id", "left").na.fill(0, ["untested"])
    reason = F.when(F.col("any_confirmed").isNull(), "no_attributes_to_test").when(F.col("untested") > 0, "untested_baselines").when(F.col("any_confirmed"), "at_least_one_attribute_confirmed").otherwise("no_attribute_confirmed")
    return every.select("case_id", ((F.col("untested") == 0) & F.coalesce("any_confirmed", F.lit(True))).alias("passed"), reason.alias("reason"), "untested")
