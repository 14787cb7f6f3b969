import pytest
from pyspark.sql import functions as F

from jobtide.functions import arrays, fields, locations, numbers, text, titles


@pytest.fixture
def over(spark):
    """Values of a Column function over a list of strings."""

    def run(f, values, *more):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string")
        return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]

    return run


def test_strip_knows_unicode_space(over):
    assert over(text.strip, ["  a b\t\n", None, " "]) == ["a b", None, ""]


def test_sentinels_are_case_sensitive(over):
    assert over(text.null_if_sentinel, ["NaN", "NAN", "null", "NULL", "", "x", " NA"]) == [None, "NAN", None, "NULL", None, "x", " NA"]


def test_markup(over):
    assert over(text.clean_html, ["<p>a</p>&amp;&#8364;&uuml;", None]) == [" a &€ü".replace(" &", " &"), None]
    assert over(lambda c: text.clean_html(c, all_entities=False), ["<b>x</b>&nbsp;y&amp;lt;"]) == [" x  y&lt;"]
    assert over(text.clean_special_chars, ["C# and F# # ** a//b 😀 | ~"]) == ["C# and F#     a b      "]
    assert over(text.preprocess_description, ["<p>a</p>\n\n\n\nb   c", "", None]) == ["a \n\nb c", "", None]
    assert over(text.strip_markdown_escapes, [r"it\-sicherheit C\+\+ a\_b"]) == [r"it-sicherheit C++ a\_b"]
    assert over(text.strip_four_escapes, [r"it\-s C\+ a\_b \*"]) == [r"it-s C+ a_b \*"]


def test_truncation(over):
    long = "First sentence is here. " + "x" * 400
    cut = over(lambda c: text.truncate_description(c, 50), [long, "short", "One. " + "y" * 160 + ". " + "z" * 100])
    assert cut[0] == "First sentence is here." + "\n[TRUNCATED]" and cut[1] == "short"
    assert cut[2] == "One. " + "y" * 160 + ".\n[TRUNCATED]"


def test_casing_score(over):
    assert over(text.casing_score, ["Acme Work IT", "acme gmbh", "SAP eCorp 24", "", None]) == [8, -2, 4, 0, 0]


def test_numbers(over):
    assert over(numbers.german_int, ["50.000", "1.234.567", "50", "5.0", "x", None, "60.000,00"]) == [50000, 1234567, 50, None, None, None, 60000]
    assert over(numbers.salary, ["50.000", "9999", "60000.0", "300001", "a"]) == [50000, None, 60000, None, None]
    assert over(numbers.experience, ["3", "11", "3.0", None]) == [3, None, 3, None]


def test_dates(over):
    ref = F.lit("2026-02-15").cast("date")
    values = ["2026-02-30x", "1735689600", "1735689600000", "Just posted", "Yesterday", "30+ days ago", "2 weeks ago", "1 month ago", "5 hours ago", "n/a", "later", None]
    assert over(lambda c: numbers.posted_date(c, ref), values) == ["2026-02-30", "2025-01-01", "2025-01-01", "2026-02-15", "2026-02-14", "2026-01-16", "2026-02-01", "2026-01-16", "2026-02-15", None, None, None]
    assert [str(x) for x in over(numbers.any_date, ["2026-02-30", "31.12.2023", "12/31/2023", "x"])] == ["None", "2023-12-31", "2023-12-31", "None"]


def test_titles(over):
    values = ["SENIOR DATA-ENGINEER (m/w/d)", "Softwareentwickler:in", "Teamleiter/-in Backend – ", "Analyst (all genders)", "Java (C++)", "Backend/Frontend (backend/frontend)", "C++/JAVA-DEVELOPER", "Entwickler*in (gn)", "X (m,w,d)", "", None]
    want = ["Senior Data-Engineer", "Softwareentwickler", "Teamleiter Backend", "Analyst", "Java (C++)", "Backend/Frontend (backend/frontend)", "C++/Java-Developer", "Entwickler", "X", "", None]
    assert over(titles.normalize_title, values) == want
    assert over(titles.translate_title, ["Senior Softwareentwickler", "Leiterin IT", "Begleiter"]) == ["Senior Software Developer", "Lead IT", "Begleiter"]


PLACES = {
    "Köln, NW, Germany": ("Köln", "North Rhine-Westphalia", "Germany", "standard_3part"),
    "Wien, Wien, Austria": ("Wien", "Wien", "Austria", "coded_3part"),
    "Hamburg, DE": ("Hamburg", "Hamburg", "Germany", "2part_city_state"),
    "Bayern, Deutschland": (None, "Bavaria", "Germany", "2part_state_only"),
    "Leipzig, Germany": ("Leipzig", None, "Germany", "2part_city"),
    "Paris, France": ("Paris", None, "France", "2part_foreign"),
    "Austin, TX": ("Austin", "TX", None, "2part_foreign"),
    "Greater Berlin Area": ("Berlin", "Berlin", "Germany", "region"),
    "Zürich Metropolitan Area": ("Zürich", "NA", "Switzerland", "region"),
    "Saarland": (None, "Saarland", "Germany", "bare_state"),
    "Germany": (None, None, "Germany", "bare_country"),
    "DACH": (None, None, "DACH", "super_region"),
    "Berlin Germany": (None, None, None, "fallback"),
    "N/A": (None, None, None, "fallback"),
}


def test_locations(over):
    assert [tuple(x) for x in over(locations.parse_location, list(PLACES))] == list(PLACES.values())
    assert tuple(over(locations.parse_location, [None])[0]) == (None, None, None, "fallback")


def test_non_german(spark):
    rows = [("Austin, TX", "TX", None), ("Cottbus", None, "Germany"), ("Remote EMEA", None, None), ("Boston Area", None, None), ("Rhein Area", None, None), ("Berlin", "Berlin", "Germany")]
    df = spark.createDataFrame(rows, "r string, s string, c string")
    both = df.select(*[locations.is_non_german(F.col("r"), F.col("s"), F.col("c"), substring_keywords=k) for k in (True, False)]).collect()
    assert [r[0] for r in both] == [True, True, True, True, False, False] and [r[1] for r in both] == [True, False, True, True, False, False]


def test_fields(spark):
    rows = [
        ("Vollzeit, 60.000 - 80.000 EUR, Präsenz, mindestens 3 Jahre, Promotion", "Senior Dev", ("Full-time", "On-site", 60000, 80000, 3, "Senior", "PhD")),
        ("unbefristeter Vertrag, mobiles Arbeiten, €80k - €110K", "CTO", ("Permanent", "Hybrid", 80000, 110000, None, "C-Level", None)),
        ("befristet, 3.000 EUR pro Monat, Langjährige Berufserfahrung", "Head of Data", ("Contract", None, None, None, 5, "Lead", None)),
        ("50.000 Mitarbeiter, ab 50.000 Euro, HOMEOFFICE", "x", (None, "Remote", None, None, None, None, None)),
        (None, "Werkstudentin", ("Working Student", None, None, None, None, "Junior", None)),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "d string, t string")
    f = fields.regex_fields(F.col("d"), F.col("t"))
    got = df.select(*[f["regex_" + n] for n in ("contract_type", "work_modality", "salary_min", "salary_max", "experience_years", "seniority_from_title", "education_level")]).collect()
    assert [tuple(r) for r in got] == [r[2] for r in rows]


def test_languages(over):
    values = ["Deutsch C1 und fließend Englisch, gute Deutschkenntnisse", "Deutsch- und Englischkenntnisse", "diversity English C1", "verhandlungssichere Deutschkenntnisse; B1 French", ""]
    got = [{x["language"]: x["level"] for x in v} for v in over(fields.languages, values)]
    assert got == [{"German": "C1", "English": "B2+"}, {"German": "required", "English": "required"}, {}, {"German": "C1+", "French": "B1"}, {}]


def test_lists(over):
    assert over(arrays.parse_list, ['["a", "b"]', "['x', None]", "no", None, "{}"]) == [["a", "b"], ["x", None], [], [], []]
    assert over(lambda c: arrays.parse_list(c, strict_json=True), ["['x']", '["y"]']) == [[], ["y"]]
    assert over(lambda c: arrays.ci_distinct(F.split(c, ",")), ["b, A,B,a,,nan,C"]) == [["b", "A", "C"]]
    assert over(lambda c: arrays.pairs(F.split(c, ",")), ["b,a,c,a", "x"]) == [[("a", "b"), ("a", "c"), ("b", "c")], []]


def test_lists_of_words_are_computed_once_and_sorted_for_clashes_only(spark, tmp_path):
    from jobtide import queries

    texts = ["b A B a  nan C", "nan  N/A", "", None, "x y x y", "Straße straße STRASSE", "\u00a0q Q"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = queries.list_ci_dedup(spark, str(tmp_path))
    assert {r.doc_id: r.words for r in df.collect()} == {0: "b A C", 4: "x y", 5: "Straße STRASSE", 6: "q"}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("array_join(") == 1
