from pyspark.sql import functions as F

from tidemark.functions import canon


def one(spark, values, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_decimals(spark):
    assert one(spark, ["1.50", "0.00", "-0.0", "10", "100", "1.", "-2.340", None], canon.canonical_decimal) == ["1.5", "0", "0", "10", "100", "1", "-2.34", None]
    assert one(spark, ["1234567.80", "999", "1000"], canon.grouped_decimal) == ["1.234.567,80", "999", "1.000"]


def test_urls(spark):
    given = ["HTTPS://A.Example//b///c/?utm_source=x&q=1&gclid=2&r=2#top", "http://a.example/", "http://a.example/?", "http://a.example?a=1"]
    assert one(spark, given, canon.canonical_url) == ["https://a.example/b/c?q=1&r=2", "http://a.example", "http://a.example", "http://a.example?a=1"]
    assert one(spark, ["a%252540b", "100%", "a+b"], canon.decoded_url) == ["a@b", "100%", "a+b"]


def test_texts(spark):
    assert one(spark, ["Straße ÉCOLE", None], canon.fold) == ["strasse ecole", None]
    assert one(spark, ["  a \t b c "], canon.squeeze) == ["a b c"]
    assert one(spark, ["--Ayto. de X / Y--"], canon.slug) == ["ayto-de-x-y"]
    assert one(spark, ["Ñandú & Cía."], canon.authority_slug) == ["nandu-cia"]
    assert one(spark, ["ABC 1", "Abc", "123"], canon.is_upper_title) == [True, False, False]


def test_sets(spark):
    assert one(spark, [["b", "a", None, "b", "a b"]], canon.canonical_set, "array<string>") == [["a b", "a", "b"]]


def test_dates(spark):
    got = one(spark, ["3 de mayo de 2024", "31 de febrero de 2024", "12 de brumario de 1800", "hoy"], canon.spanish_date)
    assert [str(x) if x else x for x in got] == ["2024-05-03", None, None, None]
    assert one(spark, ["2024-05-03T10:00:00+02:00", "2024-05-03T10:00:00"], canon.utc_text) == ["2024-05-03T08:00:00.000000Z", None]


def test_check_digits(spark):
    assert one(spark, ["12345678Z", "12345678A", "X1234567L", "12.345.678-Z"], canon.valid_person_id) == [True, False, True, True]
    assert one(spark, ["A58818501", "A58818502", "P4600000D"], canon.valid_company_id)[:2] == [True, False]
    assert one(spark, ["ES91 2100 0418 4502 0005 1332", "ES91 2100 0418 4502 0005 1333", "GB82WEST12345698765432"], canon.valid_iban) == [True, False, True]


def test_ids(spark):
    assert one(spark, ["rec:a:ñ"], canon.encoded_id) == ["r-" + "rec:a:ñ".encode().hex()]
    assert one(spark, ["r-" + "rec:a:ñ".encode().hex(), "x"], canon.decoded_id) == ["rec:a:ñ", None]


def test_identifiers_of_one_small_file_are_dealt_over_all_cores(spark, sf_dir, capsys):
    from tidemark.plans.queries import QUERIES

    QUERIES["tax_controls"](spark, sf_dir).explain()
    assert "hashpartitioning(s_suppkey" in capsys.readouterr().out


def test_dealt_rows_a_task_do_not_grow(spark):
    from tidemark.operators.staging import dealt

    found = dealt(spark.range(10_000), 10_000, 100, "id")
    assert found.rdd.getNumPartitions() == 100 and found.count() == 10_000
    assert dealt(spark.range(10), 10, 100, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_classes_of_odd_identifiers(spark):
    from pyspark.sql import functions as F

    from tidemark.functions import canon

    said = {None: None, "": None, " 12.345.678-z ": "personal_identifier", "12345678A": "ambiguous_tax_identifier", "K1234567L": "personal_identifier", "A58818501": "legal_entity_tax_identifier", "a-58818502": "ambiguous_tax_identifier", "P1234567D": "legal_entity_tax_identifier", "I1234567D": None, "١2345678Z": None, "é": None}
    df = spark.createDataFrame([(k,) for k in said], "id string")
    assert {r["id"]: r["c"] for r in df.select("id", canon.tax_class(F.col("id")).alias("c")).collect()} == said
