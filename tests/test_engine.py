import gzip
import hashlib

import duckdb
import pytest

from sparkveil.operators import identity as I
from sparkveil.operators import privacy as P
from sparkveil.operators import quality as Q
from sparkveil.operators import schema as S
from sparkveil.plans import contracts as C
from sparkveil.plans import fixtures as D
from sparkveil.plans import registry as R
from sparkveil.sources import files as Z
from sparkveil.sources import ingest as G
from sparkveil.sources import ledger as L
from sparkveil.sources import tables as T

SF = "/root/testdata/sf0.001"


def rows(df):
    columns = sorted(df.columns)
    return sorted(tuple("-" if str(v) in ("None", "nan", "<NA>", "NaT") else str(v).removesuffix(".0") for v in r) for r in df[columns].to_numpy(dtype=object).tolist())


@pytest.mark.parametrize("name", ["standardize_open", "schema_drift", "scalar_functions", "customer_mapping_incremental", "product_mapping_incremental", "backfill_products_inventory", "pseudonymize_history", "mapping_violations", "quality_checks_dirty", "land_authorized", "numbering_keeps_nulls", "ingested_history", "ingested_inventory", "manifest_records", "whole_history", "landed", "report_sink", "validated_dirty", "extract_headers", "batch_schemas", "late_drift", "reused_batch", "file_hashes", "mapping_versions", "one_to_one_tiers", "dataset_types", "duplicate_rows_export", "profiles_written", "refusals", "constant_column", "hash_without_columns", "batch_metadata", "snapshot_dates", "newest_file", "new_files", "snapshot_guard"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "orders", "customer", "lineitem", "supplier", "nation", "region"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = R.QUERIES[name](spark, SF).toPandas(), con.sql(R.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_second_run_keeps_every_pair(spark):
    facts = R.history(spark, SF)
    first = I.map_customers(I.profile_customers(R._early(facts)))
    second = I.map_customers(I.profile_customers(facts), first)
    old, new = {tuple(r) for r in first.collect()}, {tuple(r) for r in second.collect()}
    assert old and old < new
    assert len({r[-1] for r in new}) == len(new)


def test_contracts_refuse_drift(spark):
    raw = D.raw_open(spark, SF)
    with pytest.raises(S.ContractError):
        S.standardize(raw.withColumnRenamed("orpo", "surprise"), C.OPEN_ORDERS, "t", C.OPEN_DROPS)
    with pytest.raises(S.ContractError):
        S.require_distinct(["a", "b", "a"])


CUSTOMERS = [("hash-a", "1", "1", "A", "Customer CUST-000001"), ("hash-b", "2", "2", "B", "Customer CUST-000002")]
PRODUCTS = [
    ("F1-U1", "F1", "U1", "d", "c", "W", "W Product W-001", "SKU-W-000001", "SKU-GRP-00001", "SKU-BASE-00001"),
    ("F1-U2", "F1", "U2", "d", "c", "W", "W Product W-002", "SKU-W-000002", "SKU-GRP-00001", "SKU-BASE-00002"),
    ("F2-U1", "F2", "U1", "d", "c", "W", "W Product W-003", "SKU-W-000003", "SKU-GRP-00002", "SKU-BASE-00001"),
]


def tables(spark, customers=CUSTOMERS, products=PRODUCTS):
    text = lambda names: ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(customers, text(C.CUSTOMER_MAPPING)), spark.createDataFrame(products, text(C.PRODUCT_MAPPING))


def test_valid_mappings_pass(spark):
    Q.validate_mappings(*tables(spark))


@pytest.mark.parametrize(
    "customers, products",
    [
        ([*CUSTOMERS, ("hash-a", "1", "1", "A", "Customer CUST-000099")], PRODUCTS),
        ([CUSTOMERS[0], ("hash-b", "2", "2", "B", "Customer CUST-000001")], PRODUCTS),
        ([CUSTOMERS[0], (None, "2", "2", "B", "Customer CUST-000002")], PRODUCTS),
        ([CUSTOMERS[0], ("hash-b", "2", "2", "B", None)], PRODUCTS),
        (CUSTOMERS, [PRODUCTS[0], (*PRODUCTS[1][:8], "SKU-GRP-00007", PRODUCTS[1][9])]),
        (CUSTOMERS, [PRODUCTS[0], (*PRODUCTS[1][:7], "SKU-W-000001", *PRODUCTS[1][8:])]),
        ([], PRODUCTS),
    ],
)
def test_broken_mappings_are_refused(spark, customers, products):
    with pytest.raises(S.ContractError):
        Q.validate_mappings(*tables(spark, customers, products))


def test_ingest_once_then_refuse_then_force(spark, tmp_path):
    source, root = tmp_path / "extract.csv", f"file://{tmp_path}/store"
    source.write_text("Order Number,Customer Name\n1001,Acme Inc\n0002,Beta LLC\n")
    out = G.ingest(spark, "history", f"file://{source}", root, "b1", "t")
    assert {r.order_number for r in out.collect()} == {"1001", "0002"}
    with pytest.raises(S.ContractError):
        G.ingest(spark, "history", f"file://{source}", root, "b2", "t")
    assert G.ingest(spark, "open", f"file://{source}", root, "b3", "t").count() == 2
    assert G.ingest(spark, "history", f"file://{source}", root, "b4", "t", force=True).count() == 4
    spark.range(3).write.parquet(f"{root}/history/batch_id=lost")  # a batch that was never committed
    assert G.committed(spark, "history", root).count() == 4


def test_publish_detects_a_stale_base(spark, tmp_path):
    root = f"file://{tmp_path}/mapping"
    customers = tables(spark)[0]
    assert G.publish(customers, root, 0) == 1
    assert G.publish(G.current(spark, root), root, 1) == 2
    for base in (1, 0, 7):
        with pytest.raises(S.ContractError):
            G.publish(customers, root, base)
    assert G.current(spark, root).count() == 2
    assert len(list((tmp_path / "mapping").glob("table-*"))) == 2  # those refused have left nothing


def test_of_two_publishers_from_one_base_one_is_refused(spark, tmp_path, monkeypatch):
    """The second looks at the versions before the first has published, and claims its number after."""
    root, customers = f"file://{tmp_path}/mapping", tables(spark)[0]
    G.publish(customers, root, 0)
    claim, between = L.Ledger._claim, []

    def late(self, kind, version, folder):
        if not between:
            between.append(1)
            G.publish(customers.limit(1), root, 1)
        return claim(self, kind, version, folder)

    monkeypatch.setattr(L.Ledger, "_claim", late)
    with pytest.raises(L.StaleError):
        G.publish(customers, root, 1)
    assert between and G.current(spark, root).count() == 1


def test_a_ledger_is_read_from_few_files(spark, tmp_path):
    ledger = L.Ledger(spark, f"file://{tmp_path}/l", "k bigint", every=4)
    assert ledger.read().count() == 0 and ledger.version() == 0
    for i in range(11):
        assert ledger.append(spark.createDataFrame([(i,)], "k bigint")) == i + 1
    assert sorted((r.k, r.version) for r in ledger.read().collect()) == [(i, i + 1) for i in range(11)]
    base, folder, later = ledger._recent()
    assert base == 8 and len(later) == 3 and ledger.version() == 11
    # Bases alone are needed for what they hold.
    for f in (tmp_path / "l" / "commits").iterdir():
        if int(f.name.lstrip(".").split(".")[0]) <= 8:
            f.unlink()
    assert ledger.read().count() == 11
    with pytest.raises(S.ContractError, match="no"):
        ledger.append(spark.createDataFrame([(99,)], "k bigint"), check=lambda before: (_ for _ in ()).throw(S.ContractError("no")))
    assert ledger.read().count() == 11 and len(list((tmp_path / "l").glob("rows-*"))) == 11


def test_a_writer_that_dies_while_it_claims_is_not_seen(spark, tmp_path):
    ledger = L.Ledger(spark, f"file://{tmp_path}/l", "k bigint")
    ledger.append(spark.createDataFrame([(1,)], "k bigint"))
    (tmp_path / "l" / "commits" / f"{2:020d}").write_text("file:/half-a-na")
    assert ledger.read().count() == 1 and ledger.version() == 1
    with pytest.raises(L.StaleError, match="abandon"):
        ledger.append(spark.createDataFrame([(2,)], "k bigint"))
    assert ledger.abandon() and not ledger.abandon()
    assert ledger.append(spark.createDataFrame([(2,)], "k bigint")) == 2


def test_history_and_open_orders_share_out_all_lines(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    history, others = D.raw_history(spark, SF).count(), D.raw_open(spark, SF).count()
    assert history + others == lines and min(history, others) > lines // 5


def orders(spark, **changes):
    given = dict.fromkeys(C.HISTORY.values(), "x") | {"source_customer_code": "1", "ship_to_customer_code": "1", "customer_name": "A", "full_sku_code": "F1-U1", "first_half_sku_code": "F1", "unique_sku_code": "U1", "product_description": "d", "product_category": "C"} | changes
    return spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given))


CATEGORY = [("C", "W")]


def mapped(spark, **changes):
    facts = orders(spark, **changes)
    return I.map_products(I.profile_products(facts), spark.createDataFrame(CATEGORY, "product_category string, pseudo_category string"))


@pytest.mark.parametrize("column", ["customer_name", "source_customer_code", "ship_to_customer_code"])
def test_null_identities_end_the_job(spark, column):
    with pytest.raises(Exception, match=f"null in identity column {column}"):
        I.map_customers(I.profile_customers(orders(spark, **{column: None})))
    with pytest.raises(S.ContractError):
        I.refuse_nulls(orders(spark, **{column: None}), I.IDENTITY)


@pytest.mark.parametrize("changes, message", [({"product_description": None}, "null in product column product_description"), ({"product_category": None}, "null in product column product_category"), ({"product_category": "other"}, "category without a pseudo category: OTHER")])
def test_products_that_cannot_be_mapped_end_the_job(spark, changes, message):
    assert mapped(spark).count() == 1
    with pytest.raises(Exception, match=message):
        mapped(spark, **changes).collect()


def test_lookups_with_repeated_keys_are_refused(spark):
    twice = spark.createDataFrame(CATEGORY * 2, "product_category string, pseudo_category string")
    with pytest.raises(S.ContractError, match="more than once"):
        I.map_products(I.profile_products(orders(spark)), twice)


def test_corrupt_sequences_are_refused(spark):
    names = lambda *xs: spark.createDataFrame([(str(i), "1", "1", "A", x) for i, x in enumerate(xs)], ", ".join(f"{n} string" for n in C.CUSTOMER_MAPPING))
    base = I.profile_customers(orders(spark))
    assert {r.pseudo_customer_name for r in I.map_customers(base, names("Customer CUST-000004", "Customer CUST-00000X")).collect()} >= {"Customer CUST-000005"}
    with pytest.raises(S.ContractError, match="no number"):
        I.map_customers(base, names("Customer CUST-00000X"))
    products = tables(spark, products=[(*PRODUCTS[0][:8], "SKU-GRP-X", "SKU-BASE-00001")])[1]
    with pytest.raises(S.ContractError, match="no number"):
        I.map_skus(products)
    added = products.unionByName(tables(spark, products=[("F9-U9", "F9", "U9", "d", "c", "W", "W Product W-009", None, None, None)])[1])
    with pytest.raises(Exception, match="codes without a number"):
        I.map_skus(added.withColumn("pseudo_full_sku_code", added.pseudo_full_sku_code.substr(1, 6)))


def test_the_unknown_category_has_one_prefix(spark):
    own = [("F7-U7", "F7", "U7", "d", "UNKNOWN", C.UNKNOWN, f"{C.UNKNOWN} Product UC-001", "SKU-UC-000001", "SKU-GRP-00007", "SKU-BASE-00007"), ("F8-U8", "F8", "U8", "d", "UNKNOWN", C.UNKNOWN, f"{C.UNKNOWN} Product UC-002", "SKU-UC2-000002", "SKU-GRP-00008", "SKU-BASE-00008")]
    found = orders(spark, full_sku_code="F9-U9", first_half_sku_code="F9", unique_sku_code="U9")
    for broken in (own, [(*own[0][:7], "none", *own[0][8:])]):
        with pytest.raises(S.ContractError, match="prefixes"):
            I.backfill_products(found, tables(spark, products=[*PRODUCTS, *broken])[1])
    out = {r.full_sku_code: r for r in I.backfill_products(found, tables(spark, products=[*PRODUCTS, own[0]])[1]).collect()}
    assert out["F9-U9"].pseudo_full_sku_code == "SKU-UC-000002" and out["F9-U9"].pseudo_product_description.endswith("UC-002")


def test_prefixes_of_two_categories_end_the_job(spark):
    with pytest.raises(Exception, match="prefix of several categories: B2"):
        I.sku_prefixes(spark.createDataFrame([("Beans",), ("Bread",), ("B2",)], "pseudo_category string").withColumn("pseudo_category", D.F.when(D.F.col("pseudo_category") == "B2", "B 2").otherwise(D.F.col("pseudo_category")))).collect()


def test_facts_are_guarded(spark, tmp_path):
    facts, (customers, products) = orders(spark), tables(spark)
    customers = customers.unionByName(I.map_customers(I.profile_customers(facts)).withColumn("pseudo_customer_name", D.F.lit("Customer CUST-000009")))
    make = lambda f, p=products, c=customers: P.pseudonymize_orders(f, p, c, "t")
    assert P.pseudonymize_orders(facts, products, customers, "t", path=f"file://{tmp_path}/a").first().customer_name == "Customer CUST-000009"
    assert spark.read.parquet(f"file://{tmp_path}/a").count() == 1
    with pytest.raises(Exception, match="no pseudonym for full_sku_code: F0-U0"):
        make(orders(spark, full_sku_code="F0-U0"))
    with pytest.raises(Exception, match="no pseudonym for customer_hash_key"):
        make(orders(spark, customer_name="Z"))
    with pytest.raises(S.ContractError, match="more than once"):
        make(facts, products.unionByName(products))
    with pytest.raises(S.ContractError, match="more than once"):
        make(facts, products, customers.unionByName(customers))
    with pytest.raises(S.ContractError, match="missing columns"):
        make(facts.drop("unique_sku_code"))
    with pytest.raises(S.ContractError, match="no rows"):
        make(facts.limit(0))
    twice = lambda f: P._orders(f, products, customers, "t", "history").withColumn("twice", D.F.explode(D.F.array(D.F.lit(1), D.F.lit(2))))
    with pytest.raises(S.ContractError, match="1 facts became 2 rows"):
        P.written_whole(facts, twice, f"file://{tmp_path}/b")
    assert not (tmp_path / "b").exists()
    with pytest.raises(S.ContractError, match="identifier columns left"):
        S.require_absent(facts, ["created_by_user"])
    with pytest.warns(UserWarning, match="row hash without columns"):
        P.hashed(facts.drop("order_date"), C.HISTORY_HASH, "t")


def test_guards_hold_under_any_projection(spark):
    """Whatever is read of facts that lack a pseudonym, and if they are only counted."""
    customers, products = tables(spark)
    facts = orders(spark)
    known = customers.unionByName(I.map_customers(I.profile_customers(facts)))
    stock = spark.createDataFrame([("7", "d", "305", "20240101")], "raw_sku string, product_description string, warehouse_code string, snapshot_date string")
    for made, message in ((P._orders(facts, products, customers, "t", "history"), "no pseudonym for customer_hash_key"), (P._orders(facts, products.limit(0), known, "t", "open"), "no pseudonym for full_sku_code"), (P._stock(stock, products, "t"), "no pseudonym for full_sku_code"), (P._stock(stock.withColumn("raw_sku", D.F.lit(None).cast("string")), products, "t"), "null in raw_sku")):
        for read in (lambda df: df.count(), *((lambda df, c=c: df.select(c).collect()) for c in made.columns[::5])):
            with pytest.raises(Exception, match=message):
                read(made)
    for made, message in ((I.profile_customers(orders(spark, customer_name=None)), "null in identity column"), (I.profile_products(orders(spark, product_category=None)), "null in product column")):
        for read in (lambda df: df.count(), lambda df: df.select(df.columns[0]).collect()):
            with pytest.raises(Exception, match=message):
                read(made)


def test_an_overcount_is_not_believed(spark, tmp_path, monkeypatch):
    """A stage that ran twice may observe more rows than there are; facts are counted before a difference counts."""

    class Twice:
        def __init__(self):
            self.get = {"rows": 2}

    class Facts:
        def __init__(self, df):
            self.df, self.sparkSession = df, df.sparkSession

        def observe(self, *_):
            return self.df

        def count(self):
            return self.df.count()

    monkeypatch.setattr(P, "Observation", Twice)
    assert P.written_whole(Facts(spark.range(1)), lambda f: f, f"file://{tmp_path}/o").count() == 1


def test_stock_of_several_snapshots_is_refused(spark):
    stock = spark.createDataFrame([("101", "d", "305", day) for day in ("20240101", "20240102")], "raw_sku string, product_description string, warehouse_code string, snapshot_date string")
    with pytest.raises(S.ContractError, match="not one value"):
        P.pseudonymize_inventory(stock, tables(spark)[1], "t")


def test_pseudonymised_tables_are_validated(spark, tmp_path):
    good = spark.createDataFrame([("Customer CUST-000001", "W Product W-001", "W", "h", "t")] * 2, "customer_name string, product_description string, product_category string, row_hash string, pseudonymized_at string")
    assert Q.validate_pseudonymized("open", good, f"file://{tmp_path}/twice")["duplicates"] == 1
    assert spark.read.parquet(f"file://{tmp_path}/twice").count() == 2
    for column, value in (("customer_name", "Acme"), ("product_description", None), ("row_hash", None)):
        with pytest.raises(S.ContractError):
            Q.validate_pseudonymized("open", good.withColumn(column, D.F.lit(value).cast("string")))
    for broken in (good.limit(0), good.drop("product_category")):
        with pytest.raises(S.ContractError):
            Q.validate_pseudonymized("open", broken)
    with pytest.raises(S.ContractError):
        Q.validate_mappings(*tables(spark, [(*CUSTOMERS[0][:4], "Acme")]))


def test_numbering_equals_one_window_and_keeps_nulls(spark):
    rows_ = [(None if i % 5 == 0 else f"g{i % 3}", f"{i * 7919 % 1000:04d}") for i in range(1000)]
    got = I.numbered(spark.createDataFrame(rows_, "g string, k string").repartition(13), ["k"], ["g"]).collect()
    places = {g: sorted(k for h, k in rows_ if h == g) for g in {g for g, _ in rows_}}
    assert len(got) == 1000 and all(places[r.g][r.seq - 1] == r.k for r in got)


def test_only_new_files_of_a_folder_are_taken(spark, tmp_path):
    folder, root = tmp_path / "drop", f"file://{tmp_path}/store"
    folder.mkdir()
    (folder / "a.csv").write_text("Order Number,Name\n1,A\n2,B\n")
    G.ingest(spark, "history", f"file://{folder}", root, "b1", "t")
    (folder / "b.csv").write_text("Order Number,Name\n3,C\n")
    out = G.ingest(spark, "history", f"file://{folder}", root, "b2", "t")
    assert sorted((r.batch_id, r.order_number) for r in out.collect()) == [("b1", "1"), ("b1", "2"), ("b2", "3")]
    records = {r.source_file.rsplit("/", 1)[-1]: r for r in G.read_manifest(spark, root).collect()}
    assert records["a.csv"].rows == 2 and records["b.csv"].rows == 1 and records["b.csv"].column_names == ["Order Number", "Name"] and records["b.csv"].duration_seconds > 0


@pytest.mark.parametrize("step", ["data", "rows", "claim"])
@pytest.mark.parametrize("stock", [False, True])
def test_a_failed_commit_leaves_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch, step, stock):
    """Whichever step fails, the old rows are read as before, nothing is left, and the run can be repeated."""
    root, key = f"file://{tmp_path}/store", "snapshot_date" if stock else "batch_id"
    name, old = ("stock_20240101.csv", tmp_path / "old" / "stock_20240101.csv") if stock else ("x.csv", tmp_path / "old" / "x.csv")
    old.parent.mkdir()
    old.write_text("a,b\n1,2\n")
    (tmp_path / name).write_text("a,b\n3,4\n5,6\n")
    first, second = f"file://{old}", f"file://{tmp_path}/{name}"
    take = (lambda p, b: G.ingest_inventory(spark, p, root, "t", force=True)) if stock else (lambda p, b: G.ingest(spark, "history", p, root, b, "t"))
    dataset = "inventory" if stock else "history"
    take(first, "b0")
    if stock:
        with pytest.raises(S.ContractError, match="has been ingested"):
            G.ingest_inventory(spark, second, root, "t")
    before = rows(G.committed(spark, dataset, root, key).toPandas())

    def fails(*_, **__):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        if step == "data":
            m.setattr(G.files, "read_files", lambda *a: spark.range(3).select(D.F.raise_error(D.F.lit("disk full")).alias("a"), D.F.lit("x").alias(Z.SOURCE)))
            m.setattr(G, "require_rows", lambda *a: None)
        else:
            m.setattr(L.Ledger, "append" if step == "rows" else "_claim", fails)
        with pytest.raises(Exception, match="disk full"):
            take(second, "b1")
    assert rows(G.committed(spark, dataset, root, key).toPandas()) == before and G.read_manifest(spark, root).count() == 1
    assert len(list((tmp_path / "store" / dataset).glob("*/load=*"))) == 1 and len(list((tmp_path / "store" / "manifest").glob("rows-*"))) == 1
    out = take(second, "b1")
    assert out.count() == (2 if stock else 3)


def test_a_used_batch_id_is_refused(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    for n in (1, 2):
        (tmp_path / f"{n}.csv").write_text(f"a,b\n{n},2\n")
    G.ingest(spark, "history", f"file://{tmp_path}/1.csv", root, "b/ 1", "t")
    for force in (False, True):
        with pytest.raises(S.ContractError, match="has been ingested"):
            G.ingest(spark, "history", f"file://{tmp_path}/2.csv", root, "b/ 1", "t", force)
    assert [(r.batch_id, r.a) for r in G.committed(spark, "history", root).collect()] == [("b/ 1", "1")]
    assert G.ingest(spark, "open", f"file://{tmp_path}/2.csv", root, "b/ 1", "t").first().a == "2"


def test_content_that_another_run_takes_in_meanwhile_is_refused(spark, tmp_path, monkeypatch):
    root, source = f"file://{tmp_path}/store", f"file://{tmp_path}/1.csv"
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    claim, between = L.Ledger._claim, []

    def late(self, kind, version, folder):
        if not between:
            between.append(1)
            G.ingest(spark, "history", source, root, "b2", "t")
        return claim(self, kind, version, folder)

    monkeypatch.setattr(L.Ledger, "_claim", late)
    with pytest.raises(S.ContractError, match="meanwhile"):
        G.ingest(spark, "history", source, root, "b1", "t")
    assert [r.batch_id for r in G.committed(spark, "history", root).collect()] == ["b2"]


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    folder, root = tmp_path / "drop", f"file://{tmp_path}/store"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("Y,x ,Z z\n20,10,30\n")
    (folder / "c.csv").write_bytes('\ufeffx,"y\n1"\r\n"two\nlines","a ""quoted"" word, and more"\r\n,\r\n" blank ",""\r\n'.encode())
    (folder / "d d.csv").write_text("x,y\n")
    (folder / "_SUCCESS").write_text("x")
    (folder / "_temporary").mkdir()
    (folder / "_temporary" / "t.csv").write_text("x,y\n7,7\n")
    (folder / "more").mkdir()
    (folder / "more" / "e.csv").write_text("x,y\n5,6\n")
    out = G.ingest(spark, "history", f"file://{folder}", root, "b1", "t")
    assert out.columns == ["batch_id", "x", "y", "y\n1", "z_z", "ingested_at"] or set(out.columns) == {"batch_id", "x", "y", "y\n1", "z_z", "ingested_at"}
    found = {tuple(r[c] for c in ("x", "y", "y\n1", "z_z")) for r in out.collect()}
    assert found == {("5", "6", None, None), ("1", "2", None, None), ("10", "20", None, "30"), ("two\nlines", None, 'a "quoted" word, and more', None), (None, None, None, None), (" blank ", None, None, None)}
    kept = {r.source_file.rsplit("/", 1)[-1]: (r.rows, r.column_names) for r in G.read_manifest(spark, root).collect()}
    assert kept == {"e.csv": (1, ["x", "y"]), "a.csv": (1, ["x", "y"]), "b.csv": (1, ["Y", "x ", "Z z"]), "c.csv": (3, ["x", "y\n1"]), "d d.csv": (0, ["x", "y"])}


def test_stores_that_only_hadoop_opens(spark, tmp_path):
    """A view of file systems that executors' Python does not know gives the same batch and the same hashes."""
    (tmp_path / "in" / "drop").mkdir(parents=True)
    (tmp_path / "in" / "drop" / "a b.csv").write_bytes(b'x,"y ""1"""\r\n1,"2\n3"\r\n')
    spark.range(2).selectExpr("id AS x").coalesce(1).write.parquet(f"file://{tmp_path}/in/table")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.sight.link./in", f"file://{tmp_path}/in")
    root = f"file://{tmp_path}/store"
    out = G.ingest(spark, "history", "viewfs://sight/in/drop", root, "b1", "t")
    assert [(r.x, r['y_"1"']) for r in out.collect()] == [("1", "2\n3")]
    with pytest.raises(S.ContractError, match="has been ingested"):
        G.ingest(spark, "history", f"file://{tmp_path}/in/drop", root, "b2", "t")
    assert [r.rows for r in G.read_manifest(spark, root).collect()] == [1]
    assert G.ingest(spark, "open", "viewfs://sight/in/table", root, "b1", "t").count() == 2


def test_vacuum_deletes_what_no_batch_reads(spark, tmp_path):
    root, name = f"file://{tmp_path}/store", "stock_20240101.csv"
    for n in (1, 2, 3):
        (tmp_path / name).write_text("a\n" + f"{n}\n" * n)
        G.ingest_inventory(spark, f"file://{tmp_path}/{name}", root, "t", force=True)
    (tmp_path / "store" / "inventory" / "snapshot_date=20240102" / "load=lost").mkdir(parents=True)
    assert G.vacuum(spark, "inventory", root) == 3 and G.vacuum(spark, "inventory", root) == 0
    assert [r.a for r in G.committed(spark, "inventory", root, "snapshot_date").collect()] == ["3"] * 3


@pytest.mark.parametrize("body", ["x,y\n1\n", "x,y\n1,2,3\n", 'x,y\n1,"2"\n3\n'])
def test_ragged_rows_end_the_job(spark, tmp_path, body):
    (tmp_path / "x.csv").write_text(body)
    with pytest.raises(Exception, match="(?i)malformed"):
        G.ingest(spark, "history", f"file://{tmp_path}/x.csv", f"file://{tmp_path}/s", "b", "t")
    assert G.committed(spark, "history", f"file://{tmp_path}/s").count() == 0


def test_a_column_of_a_later_batch_is_refused(spark, tmp_path):
    raw, root = D.raw_open(spark, SF).drop("batch_id", "ingested_at"), f"file://{tmp_path}/store"
    for n, df in (("1", raw.limit(5)), ("2", raw.limit(7).withColumn("surprise", D.F.lit("1")))):
        df.coalesce(1).write.option("header", True).csv(f"file://{tmp_path}/{n}")
        G.ingest(spark, "open", f"file://{tmp_path}/{n}", root, f"b{n}", "t")
    standard = lambda df: S.standardize(df, C.OPEN_ORDERS, "t", C.OPEN_DROPS)
    for df in (G.read_batch(spark, "open", root), G.latest_batch(G.committed(spark, "open", root))):
        with pytest.raises(S.ContractError, match="surprise"):
            standard(df)
    assert standard(G.read_batch(spark, "open", root, "b1")).count() == 5
    with pytest.raises(S.ContractError, match="no batch"):
        G.read_batch(spark, "open", root, "b3")


def test_files_of_any_size_are_hashed_in_chunks(tmp_path, monkeypatch):
    """Over 2 GB, sparse; no read asks for more than a chunk."""
    import hashlib

    big = tmp_path / "big.csv"
    with big.open("wb") as f:
        f.write(b"x,y\n")
        f.truncate((1 << 31) + 12345)
    want = hashlib.md5(b"x,y\n")
    left = (1 << 31) + 12345 - 4
    while left:
        want.update(bytes(min(left, 1 << 24)))
        left -= min(left, 1 << 24)
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert Z.scanned_file(f"file://{big}")[:4] == (want.hexdigest(), (1 << 31) + 12345, ["x", "y"], False)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000  # KB


def test_headers_with_a_name_twice_and_parquet_extracts(spark, tmp_path):
    (tmp_path / "x.csv").write_text("x,X \n1,2\n")
    with pytest.raises(S.ContractError, match="more than once"):
        G.ingest(spark, "history", f"file://{tmp_path}/x.csv", f"file://{tmp_path}/s", "b", "t")
    spark.range(3).selectExpr("id AS `Order No.`").coalesce(1).write.parquet(f"file://{tmp_path}/extract")
    assert G.ingest(spark, "history", f"file://{tmp_path}/extract", f"file://{tmp_path}/s", "b", "t").columns == ["batch_id", "order_no.", "ingested_at"]


def test_stock_snapshots(spark, tmp_path):
    drop, root = tmp_path / "drop", f"file://{tmp_path}/store"
    drop.mkdir()
    for name, n in (("inventory_20240101.csv", 2), ("inventory_20250230.csv", 1), ("inventory_20240108.csv", 3), ("~$inventory_20240115.csv", 1)):
        (drop / name).write_text("SKU,Lot No.\n" + "1,L\n" * n)
        import os

        os.utime(drop / name, (1_700_000_000 + n, 1_700_000_000 + n))
    assert G.find_extract(spark, f"file://{drop}", "inventory_").endswith("inventory_20240108.csv")
    take = lambda name, **more: G.ingest_inventory(spark, f"file://{drop}/{name}", root, "t", **more)
    take("inventory_20240101.csv")
    assert take("inventory_20240108.csv").count() == 5
    with pytest.raises(S.ContractError, match="has been ingested"):
        take("inventory_20240108.csv")
    (drop / "inventory_20240108.csv").write_text("SKU,Lot No.\n1,L\n")
    out = take("inventory_20240108.csv", force=True)
    assert {(r.snapshot_date, r.warehouse_code) for r in out.collect()} == {("20240101", "305"), ("20240108", "305")} and out.count() == 3
    with pytest.raises(S.ContractError, match="no date"):
        take("inventory_20250230.csv")
    with pytest.raises(S.ContractError, match="no extract"):
        G.find_extract(spark, f"file://{drop}", "orH")


LAND = "batch_id string, v string"


def test_landing_refuses_batches_without_their_report(spark, tmp_path):
    facts = spark.createDataFrame([("b1", "x"), ("b2", "y")], LAND)
    report = lambda *rows_: spark.createDataFrame(rows_, "batch string, overall_status string")
    for reports, message in ((report(("b1", "passed"), ("b2", "failed")), "without"), (report(("b1", "passed")), "without"), (report(("b1", "passed"), ("b2", "passed"), ("b2", "failed")), "disagree"), (report(("b1", "passed"), ("b2", "passed"), ("b2", None)), "disagree")):
        with pytest.raises(S.ContractError, match=f"{message}.*b2"):
            G.land(facts, reports, f"file://{tmp_path}/bad", "history")
    assert G.landings(spark, f"file://{tmp_path}/bad", "history").count() == 0
    target = f"file://{tmp_path}/good"
    G.land(facts, report(("b1", "passed"), ("b2", "passed_with_warnings"), ("b3", "failed")), target, "history")
    assert {r.batch for r in G.landed_reports(spark, target, "history").collect()} == {"b1", "b2"}
    assert G.landed(spark, target, "history", LAND).count() == 2
    # Landed anew, a batch replaces what it was, and its report.
    again = spark.createDataFrame([("b2", "z"), ("b2", "zz")], LAND)
    G.land(again, report(("b2", "passed")), target, "history")
    assert sorted((r.batch_id, r.v) for r in G.landed(spark, target, "history", LAND).collect()) == [("b1", "x"), ("b2", "z"), ("b2", "zz")]
    assert sorted((r.batch, r.overall_status) for r in G.landed_reports(spark, target, "history").collect()) == [("b1", "passed"), ("b2", "passed")]


@pytest.mark.parametrize("step", ["report", "commit"])
def test_a_failed_landing_shows_nothing(spark, tmp_path, monkeypatch, step):
    facts, target = spark.createDataFrame([("b1", "x")], LAND), f"file://{tmp_path}/t"
    good = spark.createDataFrame([("b1", "passed")], "batch string, overall_status string")
    G.land(facts, good, target, "history")

    def fails(*_, **__):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(L.Ledger, "append", fails)
        else:
            m.setattr(G, "authorized", lambda *a: fails())
        with pytest.raises(OSError):
            G.land(facts.withColumn("v", D.F.lit("new")), good, target, "history")
    assert [r.v for r in G.landed(spark, target, "history", LAND).collect()] == ["x"] and len(list((tmp_path / "t" / "history").glob("load=*"))) == 1


def test_rows_of_repeated_keys_come_without_a_window(spark):
    keys = [None] * 500 + ["hot"] * 900 + [f"k{i // 2}" for i in range(400)] + [f"single{i}" for i in range(300)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "row_hash string, occurrences int").withColumnRenamed("occurrences", "id")
    out = Q.duplicate_rows(df)
    got = {(r.row_hash, r.id, r.occurrences) for r in out.collect()}
    assert got == {(k, i, keys.count(k)) for i, k in enumerate(keys) if keys.count(k) > 1} and out.count() == 1800
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_one_to_one_checks_copy_no_rows(spark):
    plan = I.two_ways(tables(spark)[1], "full_sku_code", "pseudo_full_sku_code")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    with pytest.raises(S.ContractError, match="not one-to-one"):
        I.require_one_to_one(tables(spark, products=[PRODUCTS[0], (*PRODUCTS[1][:9], "SKU-BASE-00001")])[1])
    I.require_one_to_one(tables(spark)[1])


def test_profiles_are_written(spark, tmp_path):
    facts = orders(spark)
    products = I.profile_products(facts)
    G.write_profiles(I.profile_customers(facts), products, I.category_profile(products), f"file://{tmp_path}")
    assert spark.read.parquet(f"file://{tmp_path}/category_profile").first().products == 1


def test_tables_of_an_application_can_be_released(spark):
    df = T.materialized(spark.range(3))
    assert df.count() == 3 and T.release(spark) >= 1
    with pytest.raises(Exception, match="exist|FILE_NOT_EXIST"):
        df.count()


def test_summary_tells_types(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 0.5, None)], "a bigint, `b.c` double, c string")
    assert [tuple(r) for r in S.summary(df).collect()] == [(2, 3, "a", "bigint", 2), (2, 3, "b.c", "double", 1), (2, 3, "c", "string", 1)]
    assert S.drifted(df.limit(0), {"a": "a", "b.c": "b", "c": "c"}).count() == 0


def test_fixed_lists_stand_as_written():
    """Whole lists, written down here by hand, apart from those that queries and SQL share."""
    assert " ".join(f"{k}={v}" for k, v in C.HISTORY.items()) == (
        "orcomp=company_code orsocs=source_customer_code orshcs=ship_to_customer_code orshnm=customer_name orpo=purchase_order_number ornum=order_number ortype=order_type orodt8=order_date "
        "orsdt8=scheduled_ship_date orsdat=shipped_date oruser=created_by_user ordrte=delivery_route orstat=order_status orpoq=ordered_quantity 00015=full_sku_code orman=first_half_sku_code "
        "orprod=unique_sku_code ordes1=product_description orpoq2=secondary_order_quantity orroq=final_order_quantity orpsqt=shipped_order_quantity 00022=quantity_short orpswt=shipped_order_weight "
        "orpamt=order_amount 00025=product_category batch_id=batch_id ingested_at=ingested_at_datetime"
    )
    assert " ".join(f"{k}={v}" for k, v in C.OPEN_ORDERS.items()) == (
        "orcomp=company_code orsocs=source_customer_code orshcs=ship_to_customer_code orshnm=customer_name orpo=purchase_order_number ornum=order_number orodt8=order_date orsdt8=scheduled_ship_date "
        "orstat=order_status orman=first_half_sku_code orprod=unique_sku_code ordes1=product_description orroq=final_order_quantity orpsqt=shipped_order_quantity ortype=order_type "
        "orpewt=estimated_order_weight rtname=delivery_route_name rtnumb=delivery_route orrqdt=customer_requested_date orrvdt=revised_delivery_date orpswt=shipped_order_weight 00011=full_sku_code "
        "orpamt=order_amount batch_id=batch_id ingested_at=ingested_at_datetime"
    )
    assert " ".join(f"{k}={v}" for k, v in C.INVENTORY.items()) == (
        "sku=raw_sku description=product_description pallet_no.=pallet_number lot_no.=lot_number slot=slot_location pallet_held=pallet_held_flag prod'n_date=production_date bb_date=best_before_date "
        "res_qty=reserved_quantity qty=quantity_on_hand wgt=weight"
    )
    assert C.OPEN_DROPS == ["orsdat", "orpval", "oruser"] and C.UNKNOWN == "Unknown Category"
    shared = "company_code source_customer_code ship_to_customer_code customer_name purchase_order_number order_number order_type order_date scheduled_ship_date"
    assert " ".join(C.HISTORY_HASH) == f"{shared} shipped_date delivery_route order_status ordered_quantity full_sku_code first_half_sku_code unique_sku_code final_order_quantity shipped_order_quantity quantity_short shipped_order_weight order_amount product_category product_description"
    assert " ".join(C.OPEN_HASH) == f"{shared} order_status full_sku_code first_half_sku_code unique_sku_code final_order_quantity shipped_order_quantity estimated_order_weight shipped_order_weight delivery_route customer_requested_date revised_delivery_date order_amount product_description"
    assert " ".join(C.INVENTORY_HASH) == "warehouse_code snapshot_date full_sku_code pallet_number lot_number slot_location production_date best_before_date reserved_quantity quantity_on_hand weight"
    order = "company_code customer_name purchase_order_number order_number order_type order_date scheduled_ship_date"
    last = "full_sku_code product_description product_category row_hash pseudonymized_at"
    assert " ".join(C.GATES["history"]["required"]) == f"{order} shipped_date delivery_route order_status ordered_quantity {last}"
    assert " ".join(C.GATES["open"]["required"]) == f"{order} order_status {last}"
    assert " ".join(C.GATES["inventory"]["required"]) == "warehouse_code snapshot_date full_sku_code product_description product_category quantity_on_hand row_hash pseudonymized_at"
    assert " ".join(C.GATES["history"]["critical"]) == "order_number full_sku_code customer_name product_description product_category row_hash"
    assert " ".join(C.GATES["open"]["critical"]) == "order_number full_sku_code customer_name product_description row_hash"
    assert " ".join(C.GATES["inventory"]["critical"]) == "full_sku_code product_description row_hash"
    assert " ".join(C.GATES["history"]["numeric"]) == "ordered_quantity final_order_quantity shipped_order_quantity shipped_order_weight order_amount"
    assert " ".join(C.GATES["open"]["numeric"]) == "final_order_quantity shipped_order_quantity estimated_order_weight shipped_order_weight order_amount"
    assert " ".join(C.GATES["inventory"]["numeric"]) == "reserved_quantity quantity_on_hand weight"
    assert [C.GATES[k]["pseudonyms"] for k in ("history", "open", "inventory")] == [["customer", "product"], ["customer", "product"], ["product", "sku"]]
    assert {k: " ".join(v) for k, v in C.VALIDATED.items()} == {k: "customer_name product_description product_category row_hash pseudonymized_at" for k in ("history", "open")} | {"inventory": "product_description product_category full_sku_code row_hash pseudonymized_at"}
    assert " ".join(C.CUSTOMER_MAPPING) == "customer_hash_key source_customer_code ship_to_customer_code customer_name pseudo_customer_name"
    assert " ".join(C.PRODUCT_MAPPING) == "full_sku_code first_half_sku_code unique_sku_code product_description product_category pseudo_category pseudo_product_description pseudo_full_sku_code pseudo_first_half_sku_code pseudo_unique_sku_code"


def test_guards_stay_where_they_stand(spark):
    plan = I.profile_products(R.history(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("null in product column full_sku_code") == 1  # not inferred for the lines, whose keys equal those of parts
    assert "97" in plan and "l_partkey" in plan and not any("97" in x for x in plan.splitlines() if "l_partkey" in x)  # SKUs are made of parts alone
    plan = I.profile_customers(R.history(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5(") < plan.index("Project [")  # keys are made of distinct customers


def test_white_space_of_any_kind_leaves_both_ends(spark):
    texts = ["", " ", "\t a b \r\n", "\x0b\fx\n", "a \u0085", "a \r\n\u2028", " \u2029", "\u00a0a\u00a0", "a", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(D.X.strip("t")).collect()]
    assert got == [r[0] for r in df.select(D.F.regexp_replace("t", r"^\s+|\s+$", "")).collect()] and got[2:4] == ["a b", "x"]
    assert "trim(" in df.select(D.X.strip("t"))._jdf.queryExecution().optimizedPlan().toString()


def test_authorized_facts_stay_where_they_are(spark):
    facts = spark.range(1000).selectExpr("id", "concat('b', id % 3) AS batch_id")
    reports = facts.selectExpr("batch_id AS batch", "'passed' AS overall_status").where("batch <> 'b0'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = Q.authorized(facts, reports)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # a shuffle by batch would send each to one task
        assert found.count() == 666
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_made_distinct_before_their_least_values_are_sought(spark):
    plan = optimized(I.profile_products(R.history(spark, SF)))
    assert plan.count("Aggregate [") == 2 and plan.rindex("Aggregate [") > plan.index("null in product column full_sku_code")
    facts = spark.createDataFrame([("k", "a", "b", " y ", "small")] * 3 + [("k", "a", "b", "x ", " LARGE"), ("k", "a", "b", "x", "large")], ", ".join(f"{c} string" for c in I.PRODUCT))
    assert [tuple(r) for r in I.profile_products(facts).collect()] == [("k", "a", "b", "x", "LARGE")]


def test_missing_keys_are_sought_among_distinct_ones(spark):
    R.skus_first(spark, SF), R.customers_first(spark, SF)
    for name in ("first_unmapped_skus", "unmapped_skus", "unmapped_customers"):
        plan = optimized(R.QUERIES[name](spark, SF))
        assert plan.rindex("Aggregate [") > plan.index("Join LeftOuter")  # facts are not moved for the lookup
    plan = optimized(D.raw_open(spark, SF))
    assert not any("acctbal" in x and "p_partkey" in x for x in plan.splitlines() if "Join" in x)  # a flag goes to the parts


def test_facts_meet_customers_first_and_leave_their_keys_behind(spark, tmp_path):
    facts, products, customers = R.history(spark, SF), R.skus_first(spark, SF), R.customers_first(spark, SF)
    plan = optimized(P._orders(facts, products, customers, "t", "history")).splitlines()
    above, below = [i for i, x in enumerate(plan) if "Join LeftOuter" in x]
    assert "full_sku_code" in plan[above] and "customer_hash_key" in plan[below]
    assert not any("md5(" in x or "customer_hash_key" in x for x in plan[above:][:2])  # what the lookup of SKUs moves has no key of the customer
    P.pseudonymize_orders(facts, products, customers, "t", path=f"{tmp_path}/out")
    assert list(tmp_path.glob("out/*.zstd.parquet"))


def test_compressed_extracts_are_read_as_what_they_hold(spark, tmp_path):
    text, more = b'a,b\n1,"two\nlines"\n', b"3,4\n"
    packed = gzip.compress(text) + gzip.compress(more)  # two members, as writers that append make them
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv.gz").write_bytes(packed)
    for scan in (Z.scanned_file(f"file://{tmp_path}/in/x.csv.gz"), Z.scanned_by_hadoop(spark, f"file://{tmp_path}/in/x.csv.gz")):
        assert scan == (hashlib.md5(packed).hexdigest(), len(packed), ["a", "b"], True, "csv")
    got = G.ingest(spark, "x", f"{tmp_path}/in", f"{tmp_path}/store", "b1", "t")
    assert sorted((r.a, r.b) for r in got.collect()) == [("1", "two\nlines"), ("3", "4")]
