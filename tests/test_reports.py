from pyspark.sql import functions as F
from workbooks import grid, write_workbook

from gridloom.plans import question_report, screen_report, section_report
from gridloom.plans.intake import question_report_job, screen_report_job, section_report_job


def block(n):
    return [["Question", f"q{n}"], ["Response", f"r{n}"], ["Industry Comparison", f"c{n}"], ["Industry Average", f"a{n}"]]


QUESTIONS = [
    ["Acme Widgets NYSE:ACM (old) (MI KEY: 1; SPCIQ KEY: 2) | Overview"],
    ["Environmental"],
    ["Climate"],
    *block(1),
    ["Climate"],
    *block(2),
    ["Question", "q3"],
    ["Response", "r3"],
    ["Industry Comparison", "c3"],
]


def test_question_records(spark):
    got = question_report.records(grid(spark, {"/d/x.xlsx": QUESTIONS})).cache()
    data = [r for r in got.orderBy("row_idx").collect() if r.question]
    assert [(r.category, r.question, r.response, r.industry_comparison, r.industry_average) for r in data] == [
        ("Climate", "q1", "r1", "c1", "a1"),
        ("Climate(2)", "q2", "r2", "c2", "a2"),
    ]
    assert {(r.company_name, r.key, r.risk_type) for r in data} == {
        ("Acme Widgets", "NYSE:ACM (MI KEY: 1; SPCIQ KEY: 2)", "Environmental")
    }
    assert got.filter("question = ''").groupBy("risk_type").count().orderBy("risk_type").collect() == [
        ("Governance", 4), ("Social", 4)
    ]
    rolled = question_report.roll_up(got).collect()
    assert [(r.risk_type, r.climate_metrics_count, r.total_metrics_count) for r in rolled] == [
        ("Environmental", 1, 2), ("Social", 0, 4), ("Governance", 0, 4)
    ]
    assert question_report.roll_up(got, match="contains").first().climate_metrics_count == 2
    assert question_report.records(grid(spark, {"/d/x.xlsx": QUESTIONS}), add_placeholders=False).count() == 2


def test_blank_question_and_late_social(spark):
    sheet = [["Social"], ["Human Rights (x)"], ["Question", None], *block(0)[1:], ["Human Rights"], *block(1), ["Governance"], *block(2)]
    got = question_report.records(grid(spark, {"/d/y.xlsx": sheet})).filter("row_idx >= 0").orderBy("row_idx").collect()
    assert [(r.risk_type, r.category, r.question) for r in got] == [
        ("Social", "Human Rights (x)", "Unknown question"),
        ("Social", "Human Rights", "q1"),
        ("Governance", "Human Rights", "q2"),
    ]


def companies(spark, path, sheet):
    return tuple(question_report.companies(grid(spark, {path: sheet})).select("company_name", "key").first())


def test_company_sources(spark):
    assert companies(spark, "/d/SPGlobal_AcmeHoldingInc.NASDAQGSX_MIKEY7.xlsx", [["short"]]) == (
        "Acme Holding",
        "NASDAQGS:X (MI KEY: 7)",
    )
    assert companies(spark, "/d/Report_Acme_NYSE_AB_x.xlsx", [["short"]]) == ("Acme", "NYSE:AB")
    assert companies(spark, "/d/a.xlsx", [["Big Rock (Some id 12)", "More Here"]]) == ("Big Rock", "(Some id 12)")
    assert companies(spark, "/d/a.xlsx", [["Climate Overview"], ["Plain Holdings"]]) == ("Plain Holdings", "")
    assert companies(spark, "/d/a.xlsx", [["x"]]) == ("Unknown Company", "")


SCREENS = [
    ["Acme Corp | Screens"],
    ["Acme Corp (MI KEY: 1; SPCIQ KEY: 2)"],
    ["Company Description"],
    ["Makes things"],
    ["Primary GICS Sub-Industry", "Machinery"],
    ["Fiscal Year", "2024"],
    ["Analysis Date", "2025-01-01"],
    ["Total Revenue ($M)", "100"],
    ["Total Revenue Exposed ($M)", None],
    ["Revenue Exposed/ Total Revenue (%)", "5"],
    ["Expansion Exposure", "No"],
    ["Business Involvement Screen Group", "Revenue", "Pct", "Total"],
    ["Energy", "10", None, "100.004", None, None, "14"],
    ["Weapons", None, "2", "100", "9", "3"],
    ["Not data", "1", "1", "55"],
    ["Involvement Type", "Revenue", "Pct"],
    ["Tobacco", "1", "2"],
    ["        Retail", None, None, None, "0-5%"],
    ["Further information is locked"],
    ["        Production", "7"],
    ["Business Involvement Screen Group"],
    ["Late", "1"],
]
EMPTY = [["Nobody"], ["Healthcare"], ["Defense & Weapons"], ["Total Revenue (EUR M)", "7"]]


def test_screen_tables(spark):
    made = screen_report.tables(grid(spark, {"/d/a.xlsx": SCREENS, "/d/b_none.xlsx": EMPTY}))
    details = {r.file_path: r for r in made.details.collect()}
    acme = details["/d/a.xlsx"]
    assert (acme.name, acme.key, acme.description) == ("Acme Corp", "Acme Corp (MI KEY: 1; SPCIQ KEY: 2)", "Makes things")
    assert (acme.currency, acme.total_revenue, acme.total_revenue_exposed) == ("$M", "100", "0")
    assert (details["/d/b_none.xlsx"].name, details["/d/b_none.xlsx"].key) == ("b_none", "Unknown")
    assert details["/d/b_none.xlsx"].currency == "EUR M"
    screens = made.screens.orderBy("file_path", "row_idx").collect()
    assert [tuple(r)[4:] for r in screens if r.file_path == "/d/a.xlsx"] == [
        ("Energy", "$M", "10", "-", "100.004", "-", "0", "14"),
        ("Weapons", "$M", "-", "2", "100", "9", "3", "-"),
    ]
    assert [(r[4], r[8], r[11]) for r in screens if r.file_path == "/d/b_none.xlsx"] == [
        ("Defense & Weapons", "7", "25"), ("Healthcare", "7", "10")
    ]
    products = made.products.orderBy("file_path", "row_idx").collect()
    assert [(r.involvement_type, r.subcategory, r.revenue, r.revenue_range) for r in products if r.file_path == "/d/a.xlsx"] == [
        ("Tobacco", "", "1", "No Involvement"),
        ("Tobacco", "Retail", "-", "0-5%"),
        ("Tobacco", "Production", "7", "No Involvement"),
    ]
    defaults = [r for r in products if r.file_path == "/d/b_none.xlsx"]
    assert len(defaults) == 11 + sum(map(len, screen_report.DEFAULT_PRODUCTS.values()))
    wide = {r.name: r for r in screen_report.unified(made).collect()}
    acme = wide["Acme Corp"]
    assert (acme.bis_count, acme.bis_groups, acme.bis_revenues, acme.bis_max_ownerships) == (2, "Energy; Weapons", "10", "9")
    assert (acme.ps_count, acme.ps_involvement_types, acme.ps_subcategories) == (3, "Tobacco; Tobacco; Tobacco", "Retail; Production")
    assert (acme.ps_revenue_ranges, acme.primary_gics_sub_industry) == ("0-5%", "Machinery")
    assert wide["b_none"].bis_count == 2 and wide["b_none"].ps_revenue_ranges == ""


def test_products_stop_at_screen_name_only_when_first(spark):
    first = [["Involvement Type", "a", "b"], ["Healthcare", "1"], ["Gambling", "2"]]
    later = [["Involvement Type", "a", "b"], ["Gambling", "2"], ["Healthcare", "1"]]
    made = screen_report.tables(grid(spark, {"/d/f.xlsx": first, "/d/l.xlsx": later})).products
    found = {r.file_path: r.n for r in made.groupBy("file_path").agg(F.collect_set("involvement_type").alias("n")).collect()}
    assert sorted(found["/d/l.xlsx"]) == ["Gambling", "Healthcare"]
    assert len(found["/d/f.xlsx"]) == 11


HEADER = ["Customer Name", "Relationship Type", "Customer Revenue ($M)"]
SECTIONS = [
    ["Acme (KEY: 5)"],
    ["Disclosed Customers"],
    HEADER,
    ["Tournament Ltd", "Buyer", "1.239"],
    ["Beta", "Buyer", "n/a"],
    ["Beta", "Buyer", "n/a"],
    [None, None, None],
    ["No data here", "x", "y"],
    ["Not Disclosed"],
    ["No Data Available"],
    HEADER,
    ["Gamma", "Buyer", "3"],
]


def names(spark, files, legacy=False):
    recs = section_report.relationships(grid(spark, files), legacy)
    return sorted((r["Customer Name"], r["Disclosed Information"]) for r in section_report.output(recs, "customer").collect())


def test_sections(spark):
    path = "/d/Prefix_Acme_Customers_1.xlsx"
    recs = section_report.relationships(grid(spark, {path: SECTIONS}))
    out = section_report.output(recs, "customer")
    assert out.columns == section_report.OUTPUT_COLUMNS["customer"] and len(out.columns) == 17
    got = {r["Customer Name"]: r for r in out.collect()}
    assert sorted(got) == ["Beta", "Tournament Ltd"]
    kept = got["Tournament Ltd"]
    assert (kept["Company Name"], kept["Description"], kept["Disclosed Information"]) == ("Acme", "Acme (KEY: 5)", "Disclosed Customers")
    assert (kept["Customer Revenue ($M)"], kept["Source"]) == ("1.24", "")
    assert names(spark, {path: SECTIONS}, legacy=True) == [("Beta", "Disclosed Customers")]
    assert section_report.output(recs, "supplier").isEmpty()


def test_sections_sharing_a_header_and_plain_tables(spark):
    shared = [["Disclosed A"], ["Disclosed B"], HEADER, ["One", "x", "1"]]
    assert names(spark, {"/d/P_X_Customers_1.xlsx": shared}) == [("One", "Disclosed A"), ("One", "Disclosed B")]
    plain = [["Title"], HEADER, ["Two", "x", "1"], ["Three", "y", None]]
    assert names(spark, {"/d/P_X_Customers_1.xlsx": plain}) == [("Three", ""), ("Two", "")]
    empty = [["Title"], HEADER, ["no data"], HEADER, ["Two", "x", "1"]]
    assert names(spark, {"/d/P_X_Customers_1.xlsx": empty}) == [("Two", "")]


def test_report_jobs(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "q.xlsx", {"S": QUESTIONS})
    (source / "bad.xlsx").write_bytes(b"junk")
    figures = question_report_job(spark, str(source), str(tmp_path / "q")).first()
    assert (figures.rows_in, figures.rows_out) == (10, 3)
    assert spark.read.option("header", True).csv(str(tmp_path / "q" / "quarantine")).count() == 1
    other = tmp_path / "screens"
    other.mkdir()
    write_workbook(other / "a.xlsx", {"S": SCREENS})
    written = screen_report_job(spark, str(other), str(tmp_path / "s"))
    assert written == ["unified", "company_details", "business_involvement_screens", "products_services"]
    assert spark.read.option("header", True).csv(str(tmp_path / "s" / "unified")).count() == 1
    sided = tmp_path / "sided"
    sided.mkdir()
    write_workbook(sided / "Prefix_Acme_Customers_1.xlsx", {"S": SECTIONS, "T": [["x"]]})
    write_workbook(sided / "Prefix_Acme_Suppliers_1.xlsx", {"S": [["nothing"]]})
    write_workbook(sided / "other.xlsx", {"S": [["nothing"]]})
    done = section_report_job(spark, str(sided), str(tmp_path / "c")).collect()
    assert {r.file_path.rsplit("/", 1)[1]: (r.status, r.customer_records) for r in done} == {
        "Prefix_Acme_Customers_1.xlsx": ("success", 3),
        "Prefix_Acme_Suppliers_1.xlsx": ("fail", 0),
        "other.xlsx": ("skip", 0),
    }
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c" / "customers")).count() == 2
