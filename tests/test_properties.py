"""Property tests: Spark expressions agree with the DuckDB oracle expressions
on random texts (Java regex vs RE2, Unicode lower-casing, substring rules)."""

import duckdb
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import leads as L
from tidewater.functions.text import detect_language, strip_all
from tidewater.plans import oracle as O
from tidewater.plans.queries import lang_sql, size_number_sql

ALPHABET = list("abcdeilmnopqrstuvxyzAEIOQT'-.,~ 0123456789éèàçÉÀüô\t\n") + \
    ["le ", "la ", "les ", "vous ", "merci ", "q3 ", "Q1", "t2", "prix", "budget ", "api",
     "demo", "démo", "annuel", "people", "~60 ", "1200", "next quarter", "fin de trimestre",
     "s'il ", "Smaller team", " ", "　"]

texts = st.lists(st.sampled_from(ALPHABET), min_size=0, max_size=25).map("".join)


def _duck(sql_expr: str, values: list[str]) -> list:
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, notes VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[1] for r in con.execute(f"SELECT i, {sql_expr} FROM t ORDER BY i").fetchall()]


@settings(max_examples=4, deadline=None, derandomize=True, phases=[Phase.generate],
          suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=40, max_size=60))
def test_text_rules_agree_with_oracle(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, notes string")
    got = df.select("i", detect_language(F.col("notes")).alias("lang"),
                    L.company_size_band("notes").alias("band"),
                    F.array_join(L.intent_signals("notes"), "|").alias("sig"),
                    strip_all("notes").alias("stripped")).orderBy("i").collect()
    band_sql = ("CASE " + " ".join(f"WHEN n BETWEEN {lo} AND {hi} THEN '{lab}'"
                                   for lo, hi, lab in L.size_band_labels())
                + " ELSE '11-50' END")
    n = f"({size_number_sql("lower(COALESCE(notes, ''))")})"
    assert [r.lang for r in got] == _duck(lang_sql("notes"), values)
    assert [r.band for r in got] == _duck(band_sql.replace("n BETWEEN", f"{n} BETWEEN"), values)
    assert [r.stripped for r in got] == _duck(O.strip("notes"), values)
    flags = []
    from tidewater.functions import lexicon as lx
    t = "lower(COALESCE(notes, ''))"
    for label, words in lx.INTENT_SIGNALS:
        cond = (f"regexp_matches({t}, {O.q(O.unicode_boundaries(lx.TIMELINE_PATTERN))})"
                if words is None
                else O.any_contains_sql(t, words))
        flags.append(f"CASE WHEN {cond} THEN '{label}' END")
    sig = (f"COALESCE(NULLIF(array_to_string(list_filter([{', '.join(flags)}], "
           f"lambda x: x IS NOT NULL), '|'), ''), '{lx.NO_SIGNAL_LABEL}')")
    assert [r.sig for r in got] == _duck(sig, values)
    # the Python definitions the rules restate
    import re
    py_timeline = [bool(re.search(lx.TIMELINE_PATTERN, (v or "").lower())) for v in values]
    assert [("timeline_indicated" in r.sig) for r in got] == py_timeline
    assert [r.stripped for r in got] == [v.strip() for v in values]


KW = ["invoice ", "refund", "colis ", "retard", "bug", "500", "erreur ", "cassé", "add ",
      "feature", "2fa", "mot de passe", "urgent", "data loss", "frustré", "merci", "great ",
      "can't", "Crash", "ÉRREUR", "Légal", "outage", "DOWN", "thank you", "super", "pire "]
ticket_texts = st.lists(st.sampled_from(KW + ALPHABET), min_size=0, max_size=20).map("".join)


@settings(max_examples=4, deadline=None, derandomize=True, phases=[Phase.generate],
          suppress_health_check=list(HealthCheck))
@given(st.lists(ticket_texts, min_size=40, max_size=60))
def test_classifier_agrees_with_oracle(spark, values):
    from tidewater.operators import tickets as T
    df = spark.createDataFrame([(f"t{i}", v) for i, v in enumerate(values)],
                               "ticket_id string, text string")
    got = {r.ticket_id: tuple(r[1:]) for r in T.classify_tickets(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE tickets_clean (ticket_id VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO tickets_clean VALUES (?, ?)",
                    [(f"t{i}", v) for i, v in enumerate(values)])
    sig_sql, _ = O.CTES["ticket_sig"]
    cls_sql, _ = O.CTES["ticket_cls"]
    rows = con.execute(f"WITH ticket_sig AS ({sig_sql}) {cls_sql}").fetchall()
    want = {r[0]: tuple(r[1:]) for r in rows}
    assert got == want


NOTE_BITS = ["Budget confirmed for Q3", "Pricing objection", "Met at", " people", "~45 ",
             "Évalue des alternatives à", "Grande équipe", "sso", "prix", "cher ", "annual",
             "Smaller team than expected", "Spoke with", "T3", "12000", " 0 "]
lead_rows = st.tuples(st.sampled_from(["new", "contacted", "qualified", "won", "lost", "x", None]),
                      st.sampled_from(["referral", "event", "organic", "ads", "web", None]),
                      st.one_of(st.none(), st.integers(-200000, 20000000)),
                      st.lists(st.sampled_from(NOTE_BITS + ALPHABET), max_size=12).map("".join))


@settings(max_examples=4, deadline=None, derandomize=True, phases=[Phase.generate],
          suppress_health_check=list(HealthCheck))
@given(st.lists(lead_rows, min_size=30, max_size=50))
def test_lead_enrichment_agrees_with_oracle(spark, rows):
    from decimal import Decimal
    data = [(f"L{i}", st_, so, None if v is None else Decimal(v) / 100, n)
            for i, (st_, so, v, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "lead_id string, status string, source string, "
                                     "est_value_eur decimal(12,2), notes string")
    got = {r.lead_id: (r.company_size_band, r.lead_score, "|".join(r.intent_signals),
                       r.notes_en, r.notes_fr) for r in L.enrich_leads(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE leads_clean (lead_id VARCHAR, status VARCHAR, source VARCHAR, "
                "est_value_eur DECIMAL(12,2), notes VARCHAR)")
    con.executemany("INSERT INTO leads_clean VALUES (?, ?, ?, ?, ?)", data)
    sql, _ = O.CTES["leads_enriched"]
    want = {r[0]: (r[1], r[2], "|".join(r[3]), r[4], r[5]) for r in con.execute(sql).fetchall()}
    assert got == want
