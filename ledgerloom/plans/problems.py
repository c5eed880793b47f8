"""Queries of the general problems (1, 5 and 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.keys import concept_key, iso_day, org_number
from ledgerloom.operators import compare, dewey, units
from ledgerloom.session import spread, written
from ledgerloom.sources.tables import table

#: The kinds of object in a filing, by schema path, and their scalar members. Members found
#: besides these get columns too; kinds of object besides these are rows of ``p1_others``.
FILING_TABLES = {
    "notes": ("noter[]", ["noteNr", "tittel", "merknader", "tabell"]),
    "items": ("noter[].poster[]", ["navn", "belop"]),
    "subitems": ("noter[].poster[].delposter[]", ["navn", "belop"]),
    "seats": ("styre[]", ["rolle", "personRef"]),
    "terms": ("styre[].perioder[]", ["fra", "til"]),
    "addresses": ("virksomhet.adresser[]", ["type", "poststed", "linjer"]),
    "remarks": ("revisjon.anmerkninger[]", ["kode", "tekst"]),
    "comparisons": ("regnskapsperiode.sammenligning[]", ["aar"]),
    "comparison_figures": ("regnskapsperiode.sammenligning[].tall", ["sumEiendeler"]),
    "records": ("$", ["id", "journalnr", "regnskapstype", "valuta"]),
    "companies": ("virksomhet", ["organisasjonsnummer", "organisasjonsform", "morselskap"]),
    "periods": ("regnskapsperiode", ["fraDato", "tilDato"]),
    "audits": ("revisjon", ["fravalgRevisjon"]),
    "assets": ("eiendeler", ["sumEiendeler"]),
    "fixed_assets": ("eiendeler.anleggsmidler", ["sumAnleggsmidler"]),
    "current_assets": ("eiendeler.omloepsmidler", ["sumOmloepsmidler"]),
    "equity_and_debt": ("egenkapitalGjeld", ["sumEgenkapitalGjeld"]),
    "equity": ("egenkapitalGjeld.egenkapital", ["sumEgenkapital"]),
    "debt": ("egenkapitalGjeld.gjeldOversikt", ["sumGjeld"]),
    "short_term_debt": ("egenkapitalGjeld.gjeldOversikt.kortsiktigGjeld", ["sumKortsiktigGjeld"]),
    "long_term_debt": ("egenkapitalGjeld.gjeldOversikt.langsiktigGjeld", ["sumLangsiktigGjeld"]),
    "results": ("resultatregnskapResultat", ["aarsresultat"]),
    "operating_results": ("resultatregnskapResultat.driftsresultat", ["driftsresultat"]),
    "operating_income": ("resultatregnskapResultat.driftsresultat.driftsinntekter", ["sumDriftsinntekter"]),
    "operating_costs": ("resultatregnskapResultat.driftsresultat.driftskostnad", ["sumDriftskostnad"]),
    "financial_results": ("resultatregnskapResultat.finansresultat", ["nettoFinans"]),
    "financial_income": ("resultatregnskapResultat.finansresultat.finansinntekt", ["sumFinansinntekter"]),
    "financial_costs": ("resultatregnskapResultat.finansresultat.finanskostnad", ["sumFinanskostnad"]),
}


def filing_nodes(spark: SparkSession, d: str) -> DataFrame:
    return dewey.label_nodes(spread(table(spark, d, "brreg_filings").select("rec_id", "raw_response")), "rec_id", "raw_response")


def _filing_tables(spark: SparkSession, d: str) -> DataFrame:
    """All objects of all filings, labelled and written once a session; each flat table is cut from its partition."""
    known = spark.sparkContext.__dict__.get("_ledgerloom_written", {})
    if (key := f"filing nodes of {d}") in known:
        return spark.read.parquet(known[key])
    return written(dewey.in_buckets(filing_nodes(spark, d)), key, "path_bucket")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return dewey.element_links(filing_nodes(spark, d), "rec_id")


def _filing_table(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        path, columns = FILING_TABLES[name]
        return dewey.flat_table(_filing_tables(spark, d), "rec_id", path, columns, found=True)

    return run


def p1_others(spark: SparkSession, d: str) -> DataFrame:
    return dewey.other_objects(_filing_tables(spark, d), "rec_id", [path for path, _ in FILING_TABLES.values()])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _quantities(spark, d).where("converted").select("fact_id", "common_unit", "amount_micro")


def _quantities(spark: SparkSession, d: str) -> DataFrame:
    kinds = table(spark, d, "concepts").select("concept_id", "data_type")  # a fixed table: the planner broadcasts it by its size
    facts = spread(table(spark, d, "ixbrl_facts").select("fact_id", "concept_id", "value_num", "value_text", "unit", "decimals"))
    return units.in_common_units(facts.join(kinds, "concept_id", "left"), "data_type", "value_num", "value_text", "unit", "decimals")


def p5_quantities(spark: SparkSession, d: str) -> DataFrame:
    return _quantities(spark, d).select("fact_id", "common_unit", "amount_micro", "converted")


def _copies(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, int]:
    facts = table(spark, d, "facts")
    rows = facts.count()
    keyed = facts.select(
        "source", "ord", org_number(F.col("orgnr")).alias("orgnr"), concept_key(F.col("concept_id")).alias("concept_id"), iso_day(F.col("period_end")).alias("period_end"), "value", "valuta", "decimals"
    )
    fields = [(F.bround("value", 0) + F.lit(0.0)).alias("value"), F.upper(F.trim("valuta")).alias("valuta"), F.col("decimals")]
    left, right = (compare.latest_rows(keyed.where(F.col("source") == s), ["orgnr", "concept_id", "period_end"], fields, "ord") for s in ("v1", "v2"))
    return left, right, rows // 2


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    left, right, rows = _copies(spark, d)
    return compare.compare_copies(left, right, ["orgnr", "concept_id", "period_end"], ("v1_only", "v2_only"), rows)


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    return p6_found(spark, d).groupBy("concept_id", "difference").agg(F.count("*").alias("n"))


_P6 = """
WITH k AS (
  SELECT source, ord, value, valuta, decimals,
    regexp_replace(orgnr, '[^0-9]', '', 'g') AS orgnr,
    'regnskap-no:' || regexp_extract(trim(concept_id), '([A-Za-z0-9]+)$', 1) AS concept_id,
    CASE WHEN regexp_matches(trim(period_end), '^[0-9]{8}$') THEN substr(trim(period_end), 1, 4) || '-' || substr(trim(period_end), 5, 2) || '-' || substr(trim(period_end), 7, 2)
         WHEN contains(period_end, '.') THEN split_part(trim(period_end), '.', 3) || '-' || lpad(split_part(trim(period_end), '.', 2), 2, '0') || '-' || lpad(split_part(trim(period_end), '.', 1), 2, '0')
         ELSE substr(trim(period_end), 1, 10) END AS period_end
  FROM facts WHERE orgnr IS NOT NULL AND concept_id IS NOT NULL AND period_end IS NOT NULL),
l AS (
  SELECT source, orgnr, concept_id, period_end, round_even(value, 0) AS value, upper(trim(valuta)) AS valuta, decimals FROM k
  QUALIFY row_number() OVER (PARTITION BY source, orgnr, concept_id, period_end ORDER BY ord DESC) = 1),
j AS (
  SELECT coalesce(a.orgnr, b.orgnr) AS orgnr, coalesce(a.concept_id, b.concept_id) AS concept_id, coalesce(a.period_end, b.period_end) AS period_end,
    CASE WHEN b.orgnr IS NULL THEN ['v1_only'] WHEN a.orgnr IS NULL THEN ['v2_only']
      ELSE [CASE WHEN a.value IS DISTINCT FROM b.value THEN 'value' END, CASE WHEN a.valuta IS DISTINCT FROM b.valuta THEN 'valuta' END, CASE WHEN a.decimals IS DISTINCT FROM b.decimals THEN 'decimals' END] END AS kinds
  FROM (SELECT * FROM l WHERE source = 'v1') a FULL JOIN (SELECT * FROM l WHERE source = 'v2') b USING (orgnr, concept_id, period_end))
SELECT * FROM (SELECT orgnr, concept_id, period_end, unnest(kinds) AS difference FROM j) WHERE difference IS NOT NULL"""

QUERIES = {
    "p1_found": p1_found,
    **{f"p1_{name}": _filing_table(name) for name in FILING_TABLES},
    "p1_others": p1_others,
    "p5_found": p5_found,
    "p5_quantities": p5_quantities,
    "p6_found": p6_found,
    "p6_rates": p6_rates,
}

SQL = {
    "p6_found": _P6,
    "p6_rates": f"SELECT concept_id, difference, count(*) AS n FROM ({_P6}) GROUP BY concept_id, difference",
}
