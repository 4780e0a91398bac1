import datetime as dt
import json
import os

from pyspark.sql import functions as F

from fixtures import write_landing
from finflow.plans.batch_run import run_batch
from finflow.sources import files as FS
from finflow.sources import readers as RD


def test_gate_type_names(spark, tmp):
    land = os.path.join(tmp, "landing")
    write_landing(land)
    inv = FS.gate(FS.manifest(spark, land))
    rows = {os.path.basename(r.path): r for r in
            inv.select("path", "reason", "is_valid", FS.file_type("path").alias("t"),
                       FS.staged_name("path").alias("s")).collect()}
    assert rows["notes_2026.txt"].reason == "Unsupported file type: .txt"
    assert rows["sales_2026_20260227_000000.CSV"].t == "CSV"
    assert rows["crm_customers_2026_20260226.xlsx"].t == "Excel"
    assert rows["erp_finance_2026_20260226.csv"].s == "ingested/erp_finance_2026_20260226.csv"
    small = FS.gate(FS.manifest(spark, land), max_bytes=10)
    assert small.filter(F.col("reason").startswith("File too large")).count() >= 5
    d = FS.discover(inv.filter("is_valid"))
    assert "notes_2026.txt" not in [os.path.basename(r.path) for r in d.collect()]


def test_archive_name_collisions_summary_checksums(spark, tmp):
    land = os.path.join(tmp, "landing")
    write_landing(land)
    os.makedirs(os.path.join(land, "copy"), exist_ok=True)
    with open(os.path.join(land, "erp", "sales_dup_2026_20260226_102346.csv"), "rb") as f:
        data = f.read()
    with open(os.path.join(land, "copy", "sales_dup_2026_20260226_102346.csv"), "wb") as f:
        f.write(data)
    m = FS.manifest(spark, land)
    coll = FS.name_collisions(m.withColumn("staged_name", FS.staged_name("path"))).collect()
    assert len(coll) == 2
    assert {r.n_files for r in coll} == {2}
    c = FS.checksums(spark, land)
    dup = FS.duplicate_contents(c).collect()
    assert len(dup) == 2 and dup[0].n_files == 2
    assert "notes_2026.txt" not in [os.path.basename(r.path) for r in c.collect()]   # never read
    assert FS.checksums(spark, land, max_bytes=5).count() == 0         # the 8-byte csv is excluded too
    summ = {r.domain: r for r in FS.raw_summary(m, land).collect()}
    assert summ["erp"].n_files == 4 and len(summ["erp"].first_two) == 2 and summ["erp"].n_more == 2
    a = m.select(FS.archive_name("path", F.lit(dt.datetime(2026, 2, 26))).alias("a")).first().a
    assert a.startswith("archive/2026/02/26/")
    hdr = {os.path.basename(r.path): r.first_line for r in FS.csv_headers(spark, land).collect()}
    assert hdr["erp_finance_2026_20260226.csv"].startswith("transaction_id,sale_id")
    assert "crm_customers_2026_20260226.xlsx" not in hdr


def test_readers(spark, tmp):
    land = os.path.join(tmp, "landing")
    paths = write_landing(land)
    js = RD.read_json(spark, [paths["crm/customer_interactions_2026_20260226.json"]])
    assert "meta.agent.id" in js.columns and "meta.tags" in js.columns
    xl = RD.read_xlsx(spark, [paths["crm/crm_customers_2026_20260226.xlsx"]])
    assert xl.count() == 4 and set(["customer_id", "email", "province"]) <= set(xl.columns)
    bad = os.path.join(tmp, "bad.csv")
    with open(bad, "w") as f:
        f.write("a,b\n1,2\n3\n4,5,6\n")
    df = RD.read_csv_group(spark, [bad], ["a", "b"]).cache()
    assert [(r.a, r.b) for r in df.orderBy("a").collect()] == [("1", "2"), ("3", None), ("4", "5")]
    assert [r.a for r in df.filter(F.col(RD.CORRUPT).isNotNull()).collect()] == ["4"]   # a short row is filled up


def test_csv_quoting_marks_and_null_words(spark, tmp):
    """Quoted commas, doubled quotes, line breaks, a byte-order mark, a quoted header, a very
    long header and missing-value words."""
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    wide = ",".join(f"column_{i:06d}" for i in range(9000))
    with open(os.path.join(land, "sales_2026.csv"), "w", encoding="utf-8-sig", newline="") as f:
        f.write('sale_id,"sale date, local","note ""x""\nline two"\r\n'
                'S1,"2026-01-01","He said ""hi"", twice\nand left"\r\nS2,NA,null\r\nS3,n/a, NA \r\n')
    with open(os.path.join(land, "wide_2026.csv"), "w") as f:
        f.write(wide + "\n" + "," * 8999 + "\n")
    heads = {os.path.basename(r.path): r for r in FS.csv_headers(spark, land).collect()}
    cols = RD.csv_header(heads["sales_2026.csv"].first_line)
    assert cols == ["sale_id", "sale date, local", 'note "x"\nline two']
    assert len(RD.csv_header(heads["wide_2026.csv"].first_line)) == 9000
    got = RD.read_csv_group(spark, [heads["sales_2026.csv"].path], cols).orderBy("sale_id").collect()
    assert [tuple(r)[:3] for r in got] == [("S1", "2026-01-01", 'He said "hi", twice\nand left'), ("S2", None, None), ("S3", None, " NA ")]
    assert all(r[RD.CORRUPT] is None for r in got)
    assert RD.csv_header("a,a,,b,a") == ["a", "a.1", "Unnamed: 2", "b", "a.2"]


def _workbook(path, sheets, styles="", shared="", props=""):
    """sheets: (part name, sheet XML) in tab order; the first tab's part need not be sheet1."""
    import zipfile
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    tabs = "".join(f'<sheet name="t{i}" sheetId="{i + 1}" r:id="r{i}"/>' for i in range(len(sheets)))
    rels = "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/{n}"/>' for i, (n, _) in enumerate(sheets))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}">{props}<sheets>{tabs}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for n, body in sheets:
            z.writestr(f"xl/worksheets/{n}", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{shared}</sst>')


def test_workbook_order_dates_and_phonetics(spark, tmp):
    path = os.path.join(tmp, "dealers_2026.xlsx")
    body = ('<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>at</t></is></c><c r="C1" t="inlineStr"><is><t>at</t></is></c></row>'
            '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2" s="1"><v>45000.5</v></c><c r="C2" s="2"><v>61</v></c></row>'
            '<row r="3"><c r="A3" t="inlineStr"><is><t>NA</t></is></c><c r="B3"><v>45000.5</v></c></row>')
    styles = ('<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="164"/></cellXfs>')
    shared = '<si><t>dealer_id</t></si><si><r><t>東</t></r><r><t>京</t></r><rPh sb="0" eb="2"><t>トウキョウ</t></rPh></si>'
    _workbook(path, [("sheet2.xml", body), ("sheet1.xml", '<row r="1"><c r="A1"><v>9</v></c></row>')], styles, shared)
    rows = RD.read_xlsx(spark, [path]).orderBy("at").collect()
    assert [(r.dealer_id, r["at"], r["at.1"]) for r in rows] == [
        ("東京", "2023-03-15 12:00:00", "1900-03-01"), (None, "45000.5", None)]


def test_verdicts_use_each_files_own_columns(spark, tmp):
    """JSON files of one dataset with different keys: required columns and nulls per file."""
    import json
    land, out = os.path.join(tmp, "landing"), os.path.join(tmp, "out")
    os.makedirs(land)
    files = {"vehicles_a_2026.json": [{"vehicle_id": "V1", "vin": "A"}],
             "vehicles_b_2026.json": [{"vehicle_id": "V2", "dealer_id": None}, {"vehicle_id": "V3", "dealer_id": "D"}],
             "vehicles_c_2026.json": [{"vehicle_id": "V4", "dealer_id": "D", "maker": {"name": "x"}}]}
    for name, rows in files.items():
        with open(os.path.join(land, name), "w") as f:
            json.dump(rows, f)
    s = run_batch(spark, land, out)
    fm = {os.path.basename(m["source_file"]): m for m in s["file_metrics"]}
    assert fm["vehicles_a_2026.json"]["missing_required_columns"] == ["dealer_id"] and not fm["vehicles_a_2026.json"]["is_valid"]
    assert [fm[n]["total_null_values"] for n in sorted(fm)] == [0, 1, 0]
    assert fm["vehicles_c_2026.json"]["unexpected_columns"] == ["maker.name"] and fm["vehicles_c_2026.json"]["is_valid"]
    assert {r.vehicle_id for r in spark.read.parquet(f"{out}/staging/vehicles").collect()} == {"V2", "V3", "V4"}


def test_damaged_staging_fails_the_load_and_spares_other_datasets(spark, tmp):
    land, out = os.path.join(tmp, "landing"), os.path.join(tmp, "out")
    os.makedirs(land)
    for name, text in (("dealers_2026.csv", "dealer_id\nD1\n"), ("suppliers_2026.csv", "supplier_id\nS1\n")):
        with open(os.path.join(land, name), "w") as f:
            f.write(text)
    os.makedirs(f"{out}/staging/dealers")
    with open(f"{out}/staging/dealers/part-0.parquet", "w") as f:
        f.write("damaged")
    s = run_batch(spark, land, out)
    assert s["status"] == "FAILED" and any(e.startswith("dealers:") for e in s["errors"])
    assert spark.read.parquet(f"{out}/staging/suppliers").count() == 1
    assert os.listdir(f"{out}/staging/dealers") == ["part-0.parquet"]
    os.remove(f"{out}/staging/dealers/part-0.parquet")
    os.rmdir(f"{out}/staging/dealers")
    s = run_batch(spark, land, out)                              # only the failed dataset's file is taken up again
    assert s["files_found"] == 1 and spark.read.parquet(f"{out}/staging/dealers").count() == 1


def test_batch_run_end_to_end(spark, tmp):
    land, out = os.path.join(tmp, "landing"), os.path.join(tmp, "out")
    write_landing(land)
    s = run_batch(spark, land, out)
    fm = {os.path.basename(m["source_file"]): m for m in s["file_metrics"]}
    assert fm["sales_dup_2026_20260226_102346.csv"]["validation_errors"] == ["1 repeated rows"]
    assert "required columns absent" in fm["sales_2026_20260227_000000.CSV"]["validation_errors"][0]
    assert fm["empty_sales_2026.csv"]["validation_errors"] == ["no row was left after cleaning"]
    assert any("has no target table" in e for e in s["errors"])
    assert fm["customer_interactions_2026_20260226.json"]["is_valid"] is False
    assert [os.path.basename(p) for p in s["unmapped_files"]] == ["mystery_table_2026.csv"]
    assert s["status"] == "FAILED" and s["line"].startswith("ETL_SUMMARY::")
    sales = {r.sale_id: r for r in spark.read.parquet(os.path.join(out, "staging", "sales")).collect()}
    assert set(sales) == {"S1", "S4"}
    assert sales["S1"].customer_id == "C1"                       # first row of the file wins
    bad = {json.loads(r.row_json)["sale_id"]: r.violations for r in spark.read.parquet(os.path.join(out, "quarantine", "sales")).collect()}
    assert bad["S2"] == ["sale_price_not_negative", "final_price_not_negative"] and bad["S3"] == ["sale_channel_not_allowed"]
    assert str(sales["S4"].sale_price) == "30000.50" and sales["S4"].customer_id == "C4"
    pay = {r.payment_id: r for r in spark.read.parquet(os.path.join(out, "staging", "payments")).collect()}
    assert set(pay) == {"P1", "P3"} and pay["P1"].status == "Paid" and pay["P3"].status == "Failed"
    cust = {r.customer_id: r for r in spark.read.parquet(os.path.join(out, "staging", "customers")).collect()}
    assert set(cust) == {"C1"} and cust["C1"].email == "ada@example.com" and cust["C1"].last_name == "Lovelace"
    q = spark.read.parquet(os.path.join(out, "quarantine", "customers")).collect()
    assert [r.violations for r in q] == [["province_not_allowed"]]
    s2 = run_batch(spark, land, out, reprocess=True)
    assert s2["rows_inserted"] == 0 and s2["rows_loaded"] == s["rows_loaded"]
    # the same run written again replaces its rows
    before = spark.read.parquet(os.path.join(out, "quarantine", "customers")).count()
    s2 = run_batch(spark, land, out, reprocess=True, run_id=s2["run_id"])
    assert spark.read.parquet(os.path.join(out, "quarantine", "customers")).count() == before
    s3 = run_batch(spark, land, out)                             # every file was read once
    assert s3["files_found"] == 0 and s3["rows_loaded"] == 0
    runs = spark.read.parquet(os.path.join(out, "pipeline_metrics")).collect()
    assert {r.status for r in runs if r.files_processed} == {"FAILED"}
    log = spark.read.parquet(os.path.join(out, "etl_metadata"))
    # one entry per dataset that loaded; interactions had no accepted file
    assert sorted(r.table_name for r in log.select("table_name").distinct().collect()) == [
        "customers", "payments", "sales"]


def test_lenient_mode_dedupes(spark, tmp):
    land, out = os.path.join(tmp, "landing"), os.path.join(tmp, "out")
    write_landing(land)
    s = run_batch(spark, land, out, strict=False)
    sales = {r.sale_id for r in spark.read.parquet(os.path.join(out, "staging", "sales")).collect()}
    assert "S7" in sales


def test_unreadable_workbook_and_malformed_csv_are_file_errors(spark, tmp):
    land, out = os.path.join(tmp, "landing"), os.path.join(tmp, "out")
    os.makedirs(land)
    with open(os.path.join(land, "dealers_2026.xlsx"), "wb") as f:
        f.write(b"not a zip file")
    with open(os.path.join(land, "sales_2026.csv"), "w") as f:
        f.write("sale_id,sale_date,sale_price\nS1,2026-01-01,10\nS2,2026-01-02,11,extra\n")
    with open(os.path.join(land, "vehicles_2026.csv"), "w") as f:
        f.write("vehicle_id,dealer_id,vin\nV1,D1,VIN1\n")
    s = run_batch(spark, land, out)
    fm = {os.path.basename(m["source_file"]): m for m in s["file_metrics"]}
    assert fm["sales_2026.csv"]["validation_errors"] == ["1 malformed rows"]
    assert fm["dealers_2026.xlsx"]["is_valid"] is False
    assert fm["vehicles_2026.csv"]["is_valid"] is True          # other files still load
    assert spark.read.parquet(os.path.join(out, "staging", "vehicles")).count() == 1


def test_command_line_batch(spark, tmp, capsys):
    from finflow.__main__ import main
    land, out = os.path.join(tmp, "landing"), os.path.join(tmp, "out")
    write_landing(land)
    rc = main(["batch", "--landing", land, "--out", out])
    line = capsys.readouterr().out.strip().splitlines()[-1]
    assert rc == 1 and line.startswith("ETL_SUMMARY::")          # fixtures hold rejected files
    assert spark.read.parquet(os.path.join(out, "staging", "sales")).count() == 2


def test_header_source_reads_a_few_bytes_of_new_files_only(spark, tmp, monkeypatch):
    """One small read per new file; a header longer than a read goes on; a second run over an
    unchanged landing opens nothing; another scheme falls back to Spark's reader."""
    from finflow.sources import headers as H
    land, heads, out = (os.path.join(tmp, x) for x in ("landing", "heads", "out"))
    os.makedirs(land)
    os.makedirs(heads)
    wide = "vehicle_id,vin,dealer_id," + ",".join(f'"c, {i}\n"' for i in range(3000))
    for name, head in (("long body.csv", "vehicle_id,vin,dealer_id"), ("wide.csv", wide), ("open.csv", 'vehicle_id,"never closed')):
        with open(os.path.join(heads, name), "w") as f:
            f.write(head + "\n" + "V,VIN,D1\n" * 20_000)
    paths = [r.path for r in FS.manifest(spark, heads).collect()]
    got = {os.path.basename(r.path): r for r in H.header_records(spark, paths).collect()}
    assert (got["long body.csv"].first_line, got["long body.csv"].bytes_read) == ("vehicle_id,vin,dealer_id", H.FIRST_READ)
    assert got["wide.csv"].first_line == wide and got["wide.csv"].bytes_read <= 5 * len(wide)
    assert got["open.csv"].first_line is None and H.first_record(open(os.devnull, "rb")) == ("", 0)
    plan = H.header_records(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "BatchScan" in plan
    lines = {os.path.basename(r.path): r.first_line for r in FS.header_lines(spark, [p for p in paths if " " not in p]).collect()}
    assert lines == {"wide.csv": wide, "open.csv": None}
    asked = []
    monkeypatch.setattr(FS.H, "header_records", lambda s, p, real=H.header_records: asked.append(len(p)) or real(s, p))
    for name in ("vehicles_a_2026.csv", "vehicles_b_2026.csv"):
        with open(os.path.join(land, name), "w") as f:
            f.write("vehicle_id,vin,dealer_id\n" + f"{name[9]}1,VIN{name[9]},D1\n")
        run_batch(spark, land, out, constraints=False)
    run_batch(spark, land, out, constraints=False)
    assert asked == [1, 1] and spark.read.parquet(os.path.join(out, "staging", "vehicles")).count() == 2
