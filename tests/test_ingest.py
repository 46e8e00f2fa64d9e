"""Raw text: unreadable fields reject their row and stop nothing."""

from tillroll.sources import csv_io


def test_rejects_and_nulls(spark, tmp_path):
    p = tmp_path / "raw.csv"
    head = "TransactionID,CustomerID,ProductID,ProductCategory,Quantity,UnitPrice,TransactionDate,Country,PaymentMethod\n"
    p.write_text(head + "T1,C1,P1,x,2,1.5,2020-01-01 10:00:00,A,B\n" "T2,C1,P1,x,abc,1.5,2020-01-01 10:00:00,A,B\n"
                 "T3,C1,P1,x,2,free,2020-01-01 10:00:00,A,B\n" "T4,C1,P1,x,2,1.5,31/31/2020,A,B\n"
                 "T5,NA,P1,x,,,,A,B\n" "T6,C1,P1,x,99999999999,1.5,2020-01-01,A,B\n")
    raw = csv_io.read_raw_text(spark, str(p))
    good = {r["TransactionID"]: r for r in csv_io.accepted(raw).collect()}
    assert sorted(good) == ["T1", "T5"]
    assert good["T1"]["Quantity"] == 2 and good["T5"]["CustomerID"] is None and good["T5"]["Quantity"] is None
    reasons = {r["TransactionID"]: (r["RejectReason"], r["Quantity"]) for r in csv_io.rejected(raw).collect()}
    assert {k: v[0].split()[0] for k, v in reasons.items()} == {
        "T2": "Quantity", "T3": "UnitPrice", "T4": "TransactionDate", "T6": "Quantity"}
    assert reasons["T2"][1] == "abc"


def test_structure_and_ranges(spark, tmp_path):
    """Quotes, line breaks, surplus and missing fields, and amounts beyond their decimals: no abort, each with its reason."""
    head = "TransactionID,CustomerID,ProductID,ProductCategory,Quantity,UnitPrice,TransactionDate,Country,PaymentMethod\n"
    tail = ",2020-01-01 10:00:00,A,B\n"
    p = tmp_path / "raw.csv"
    p.write_text(head + 'T1,C1,P1,"say ""hi"", now",2,1.5' + tail + 'T2,C1,P1,"two\nlines",2,1.5' + tail
                 + "T3,C1,P1,x,2,1.5,2020-01-01 10:00:00,A,B,extra\n" + "T4,C1,P1,x,2\n" + "T5,C1,P1,x,2,1e12" + tail
                 + "T6,C1,P1,x,2000000000,99999999" + tail + "T7,C1,P1,x,2,Infinity" + tail + "T8,C1,P1,x,2,-1e300" + tail)
    raw = csv_io.read_raw_text(spark, str(p))
    good = {r["TransactionID"]: r["ProductCategory"] for r in csv_io.accepted(raw).collect()}
    assert good == {"T1": 'say "hi", now', "T2": "two\nlines"}
    found = {r["TransactionID"]: (r["RejectReason"], r["RawRecord"]) for r in csv_io.rejected(raw).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        "T3": "wrong number of fields", "T4": "wrong number of fields", "T5": "UnitPrice out of range",
        "T6": "Revenue out of range", "T7": "UnitPrice out of range", "T8": "UnitPrice out of range"}
    assert found["T3"][1].startswith("T3,") and found["T3"][1].rstrip().endswith("extra") and found["T5"][1] is None
    assert csv_io.accepted(raw).count() == 2  # a count alone prunes nothing

    from tillroll.operators import cleaning
    typed = spark.createDataFrame([("T", "C", 2, 1e12)], "TransactionID string, CustomerID string, Quantity int, UnitPrice double")
    row = cleaning.standardise(typed.selectExpr("*", "timestamp_ntz'2020-01-01' AS TransactionDate")).first()
    assert row["UnitPrice"] is None and row["Revenue"] is None
