from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructType

from citypulse.sources.quarantine import headers, read_quarantined

SCHEMA = (StructType().add("id", IntegerType()).add("name", StringType()).add("amount", DoubleType())
          .add("day", DateType()))


def _write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_planted_bad_rows_are_all_rejected(spark, tmp_path):
    path = _write(tmp_path / "in", a='id,name,amount,day\n1,"a, b",1.5,2024-01-02\nx,bad id,1,2024-01-02\n'
                  '2,few\n3,many,1,2024-01-02,9,9\nNULL,no id,1,2024-01-02\n4,  led,NULL,2024-13-40\n5,ok,NULL,NULL\n',
                  b='﻿DAY, Montant ,comment,ID\n2024-05-06, 7 ,c,6\n2024-05-06,nine,c,7\n',
                  c='name,amount\nnobody,1\n', d='id,name,amount,day\n', e='')
    kept, rejects = read_quarantined(spark, path, SCHEMA, required=["id"], renamed={"montant": "amount"})
    got = {r.id: (r.name, r.amount, str(r.day), r.file_name) for r in kept.collect()}
    assert got == {1: ("a, b", 1.5, "2024-01-02", "a.csv"), 5: ("ok", None, "None", "a.csv"),
                   6: (None, 7.0, "2024-05-06", "b.csv")}
    why = sorted((r.file_name, r.reason, r.raw) for r in rejects.collect())
    assert why == [("a.csv", "day: not a date", "4,  led,NULL,2024-13-40"),
                   ("a.csv", "id: missing", "NULL,no id,1,2024-01-02"),
                   ("a.csv", "id: not a int", "x,bad id,1,2024-01-02"),
                   ("a.csv", "malformed row", "2,few"), ("a.csv", "malformed row", "3,many,1,2024-01-02,9,9"),
                   ("b.csv", "amount: not a double", "2024-05-06,nine,c,7"), ("c.csv", "id: missing", "nobody,1")]
    # columns that are used later do not change what is malformed
    assert [sorted(r[0] or 0 for r in kept.select(c).collect()) for c in ("id", "amount")] == [[1, 5, 6], [0, 1.5, 7.0]]
    assert kept.count() == 3 and rejects.count() == 7
    assert rejects.where("reason = 'malformed row'").count() == 2


def test_repeated_names_and_headers_only(spark, tmp_path):
    path = _write(tmp_path / "in", a="id,id,name\n1,2,x\n")
    kept, rejects = read_quarantined(spark, path, SCHEMA)
    assert [r.id for r in kept.collect()] == [1] and rejects.count() == 0
    assert len(headers(spark, path)) == 1
    none = _write(tmp_path / "empty", a="")
    kept, rejects = read_quarantined(spark, none, SCHEMA)
    assert kept.count() == 0 and rejects.count() == 0 and kept.columns == [*SCHEMA.names, "file_name"]
