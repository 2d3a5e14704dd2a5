"""Seed scripts read back."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from sitewise.schema import SCHEMAS
from sitewise.sources.ingest import seed_ingest
from sitewise.sources.scripts import load_script, statements

SCRIPT = """SET FEEDBACK OFF;
ALTER SESSION SET CURRENT_SCHEMA = someone;
-- seeds, it's a start
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM, PRENOM, DATE_NAISSANCE) VALUES (EMPLOYES_SEQ.NEXTVAL,'O''Neil; J''','a
b;c',TO_DATE('03/10/2021', 'DD/MM/YYYY'));
insert into boss.employes
  (id_employe, nom,
   date_naissance, fonction_employe)
values ( employes_seq.nextval , 'it''s; ''' , to_date('2020-02-26 13:45:10','YYYY-MM-DD HH24:MI:SS') ,
  NULL );
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM) VALUES (EMPLOYES_SEQ.NEXTVAL);
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM) VALUES (EMPLOYES_SEQ.NEXTVAL, 'never closed);
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM) VALUES (500, UPPER('x'));
INSERT INTO EMPLOYES (ID_EMPLOYE, SURNAME) VALUES (500, 'x');
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM, NOM) VALUES (500, 'x', 'y');
INSERT INTO EMPLOYES SELECT * FROM OTHERS;
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM, DATE_NAISSANCE) VALUES (EMPLOYES_SEQ.NEXTVAL, 'bad day', TO_DATE('31/02/2021', 'DD/MM/YYYY'));
INSERT INTO CLIENTS (ID_CLIENT) VALUES (1);
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM) VALUES ('77', '');
INSERT INTO EMPLOYES (ID_EMPLOYE, NOM) VALUES (EMPLOYES_SEQ.NEXTVAL, 'last');
COMMIT;
"""


def test_scripts(spark, tmp_path):
    (tmp_path / "employes.sql").write_text(SCRIPT)
    rows, bad = load_script(spark, str(tmp_path / "employes.sql"), "EMPLOYES", SCHEMAS["employes"], str(tmp_path / "seq"), "first")
    shown = {(r.id_employe, r.nom, r.prenom, r.date_naissance, r.fonction_employe) for r in rows.collect()}
    assert shown == {
        (1, "O'Neil; J'", "a\nb;c", dt.datetime(2021, 10, 3), None),
        (2, "it's; '", None, dt.datetime(2020, 2, 26, 13, 45, 10), None),
        (77, None, None, None, None),
        (3, "last", None, None, None),
    }
    assert sorted(r.reason for r in bad.collect()) == [
        "a column named twice", "a column that is not known", "a value that is no literal",
        "a value that is no literal", "does not fit: date_naissance", "no insert of literal values", "not one value for each column",
    ]
    # The same load again has the same keys; another goes on.
    again, _ = load_script(spark, str(tmp_path / "employes.sql"), "EMPLOYES", SCHEMAS["employes"], str(tmp_path / "seq"), "first")
    assert sorted(r.id_employe for r in again.collect()) == [1, 2, 3, 77]
    more, _ = load_script(spark, str(tmp_path / "employes.sql"), "EMPLOYES", SCHEMAS["employes"], str(tmp_path / "seq"), "second")
    assert sorted(r.id_employe for r in more.collect()) == [4, 5, 6, 77]


def test_statements_across_splits(spark, tmp_path):
    """A file that many tasks read gives the statements it gives to one."""
    text = "".join(f"INSERT INTO T (A, B) VALUES ({i}, 'x;{'y' * (i % 300)}''\n;{i}');\n" for i in range(2_000))
    (tmp_path / "t.sql").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = [r.statement.strip() for r in statements(spark, str(tmp_path / "t.sql")).orderBy("position").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [s.strip() for s in text.split(");\n")[:-1] for s in [s + ")"]]


def test_numbers_that_would_be_rounded(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DecimalType(6, 2)), T.StructField("c", T.DoubleType())])
    rows = [("1", "1.20", "0.123456"), ("2.0", "-1.2500", "1"), ("3.5", "1", "1"), ("4", "1.255", "1"), ("x", "1", "1"), (" ", ".5", "1e3")]
    good, bad = seed_ingest(spark.createDataFrame(rows, "a string, b string, c string"), schema, exact=True)
    assert {tuple(r) for r in good.collect()} == {(1, Decimal("1.20"), 0.123456), (2, Decimal("-1.25"), 1.0), (None, Decimal("0.50"), 1000.0)}
    assert {(r.a, r.bad_columns) for r in bad.collect()} == {("3.5", "a"), ("4", "b"), ("x", "a")}
    rounded, refused = seed_ingest(spark.createDataFrame(rows, "a string, b string, c string"), schema)
    assert {r.a for r in rounded.collect()} == {1, 2, 4, None} and refused.count() == 1
