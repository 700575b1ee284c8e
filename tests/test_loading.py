"""Funnel details, checks, loading, notes."""

import pytest
from pyspark.sql import functions as F

from tidewright.operators import clustering as cg
from tidewright.operators import funnel as fn
from tidewright.operators import notes as nt
from tidewright.operators import quality as ql
from tidewright.operators import semantic as sem
from tidewright.plans import etl
from tidewright.sources import readers, writers

RAW = "user_id string, plano string, device string, etapa string, timestamp string"


@pytest.fixture
def raw(frame):
    return frame([
        (" u1 ", " Free", " ", "Cadastro ", "01/02/2024 10:00:00"), ("u1", "pro", "Web", "onboarding_inicio", "2024-02-02"),
        ("u1", "free", "ios", "cadastro", "2024/01/31"), ("u2", "pro", "", "exportacao", None), ("u3", "pro", None, "unknown", "x"),
        (None, "pro", "web", "cadastro", "2024-01-01"),
    ], RAW)


def test_silver_keeps_every_row(raw):
    rows = fn.silver(raw).collect()
    assert len(rows) == 6 and [r.stage_order for r in rows] == [1, 2, 1, 5, None, 1]
    assert [r.device for r in rows] == [None, "web", "ios", None, None, "web"]


def test_user_rows(raw):
    got = {r.user_id: r for r in fn.user_funnel(fn.silver(raw)).collect()}
    assert set(got) == {"u1", "u2", "u3"}  # a null user joins nothing
    assert (got["u1"].plano, got["u1"].device, got["u1"].total_events) == ("free", "web", 3)
    assert str(got["u1"].cadastro_ts) == "2024-01-31 00:00:00" and got["u2"].device == "unknown"


def test_mart_uses_users_and_guards_zero(raw):
    got = {(r.plano, r.device): r for r in fn.mart_segmented(fn.user_funnel(fn.silver(raw))).collect()}
    assert got[("free", "web")].pct_onboarding_inicio == 100.0 and got[("free", "web")].pct_ativacao == 0.0
    assert got[("pro", "unknown")].usuarios == 2 and got[("pro", "unknown")].pct_exportacao is None


def test_mart_shuffles_users_once(spark, raw):
    plan = fn.mart_segmented(fn.user_funnel(fn.silver(raw)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1


def test_catalogue_shape(spark):
    assert (len(sem.node_rows()), len(sem.edge_rows()), len(sem.metric_rows()), len(sem.rule_rows())) == (15, 27, 5, 5)
    chain = sem.stage_chain(sem.edges(spark))
    assert chain.count() == 10 and chain.agg(F.max("distance")).first()[0] == 4


def test_stage_order_violation(spark, raw):
    got = sem.stage_order_violations(fn.user_funnel(fn.silver(raw)), sem.edges(spark)).collect()
    assert [(r.user_id, r.broken) for r in got] == [("u2", ["exportacao<ativacao"])]


def test_csv_round_trip_is_text(spark, raw, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('user_id,plano,device,etapa,timestamp\n001," Free, x",,cadastro,2024-01-01\n')
    row = readers.csv_text(spark, str(path)).first()
    assert tuple(row) == ("001", " Free, x", None, "cadastro", "2024-01-01")


def test_markdown_folder(spark, tmp_path):
    for category, stem, text in (("runbooks", "cpu", "# CPU\nscale"), ("changelogs", "v2", "fix")):
        (tmp_path / category).mkdir()
        (tmp_path / category / f"{stem}.md").write_text(text)
    got = {r.doc_id: (r.type, r.content) for r in readers.text_documents(spark, str(tmp_path)).collect()}
    assert got == {"runbooks/cpu": ("runbooks", "# CPU\nscale"), "changelogs/v2": ("changelogs", "fix")}


def test_ndjson_reads_one_day_only(spark, frame, tmp_path):
    df = frame([(1, "2024-01-01"), (2, "2024-01-02")], "x long, d string").select("x", F.col("d").cast("date").alias("dt"))
    df.write.partitionBy("dt").json(str(tmp_path / "j"))
    day = readers.ndjson(spark, str(tmp_path / "j"), "x long", "2024-01-02")
    assert [r.x for r in day.collect()] == [2]
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()


def test_raw_replaces_its_own_dates_only(spark, frame, tmp_path):
    for rows in ([(1, "2024-01-01"), (2, "2024-01-01")], [(3, "2024-01-02")], [(4, "2024-01-01")]):
        path = writers.save_raw(frame(rows, "x long, dt string"), str(tmp_path), "t", "parquet")
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [3, 4]


def test_a_second_day_and_a_mended_day(spark, frame, tmp_path):
    rules, schema = {"price": F.col("price") > 0}, {"id": "bigint", "price": "double"}

    def load(rows, dates=None):
        df = frame(rows, "id long, price double, day string")
        return etl.ingest(df, str(tmp_path), "t", rules, schema, F.col("day"), dates=dates)

    load([(1, 5.0, "2024-01-01"), (2, -1.0, "2024-01-01")])
    paths = load([(3, -2.0, "2024-01-02"), (4, 4.0, "2024-01-02")])
    ids = lambda p: sorted(int(r.id) for r in spark.read.parquet(paths[p]).collect())
    assert (ids("raw"), ids("trusted"), ids("dlq")) == ([1, 2, 3, 4], [1, 4], [2, 3])
    load([(1, 5.0, "2024-01-01"), (2, 1.0, "2024-01-01")])
    assert (ids("raw"), ids("trusted"), ids("dlq")) == ([1, 2, 3, 4], [1, 2, 4], [3])
    load([(1, -5.0, "2024-01-01")])
    assert (ids("raw"), ids("trusted"), ids("dlq")) == ([1, 3, 4], [4], [1, 3])


def test_a_named_date_without_rows_is_emptied_in_every_layer(spark, frame, tmp_path):
    rules, schema = {"price": F.col("price") > 0}, {"id": "bigint", "price": "double"}

    def load(rows, dates):
        df = frame(rows, "id long, price double, day string")
        return etl.ingest(df, str(tmp_path), "t", rules, schema, F.col("day"), dates=dates)

    both = ["2024-01-01", "2024-01-02"]
    load([(1, 5.0, "2024-01-01"), (2, 5.0, "2024-01-02"), (3, -1.0, "2024-01-02")], both)
    paths = load([(1, 6.0, "2024-01-01"), (7, 1.0, "2024-01-09")], both)  # a date that isn't the run's is not loaded
    ids = lambda p: sorted(int(r.id) for r in spark.read.parquet(paths[p]).collect())
    assert (ids("raw"), ids("trusted")) == ([1], [1])
    assert spark.read.schema("id string").parquet(paths["dlq"]).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_rows_without_a_date_stay_with_their_load(spark, frame, tmp_path, fmt):
    rules, schema = {"price": F.col("price") > 0}, {"id": "bigint", "price": "double"}

    def load(rows, name=None):
        df = frame(rows, "id long, price double, day string")
        return etl.ingest(df, str(tmp_path), "t", rules, schema, F.col("day"), fmt=fmt, load=name)

    load([(1, 5.0, "2024-01-01"), (8, 1.0, None), (80, -1.0, None)])
    paths = load([(2, 5.0, "2024-01-02"), (9, 1.0, None)])
    read = lambda p: spark.read.format(fmt if p == "raw" else "parquet").load(paths[p])
    ids = lambda p: sorted(int(r.id) for r in read(p).collect())
    assert (ids("raw"), ids("trusted"), ids("dlq")) == ([1, 2, 8, 9, 80], [1, 2, 8, 9], [80])
    load([(2, 5.0, "2024-01-02")])  # the second load again, mended: its undated row goes, the first load's stay
    assert (ids("raw"), ids("trusted"), ids("dlq")) == ([1, 2, 8, 80], [1, 2, 8], [80])
    load([(10, 1.0, None)], "by hand")
    assert (ids("raw"), ids("trusted")) == ([1, 2, 8, 10, 80], [1, 2, 8, 10])
    assert read("trusted").where("dt IS NULL").count() == 2


def test_a_batch_that_became_empty_keeps_no_alerts(spark, frame, tmp_path):
    send, path = writers.table_sink(str(tmp_path / "a")), str(tmp_path / "a")
    send(frame([(1,)], "x long"), 1)
    send(frame([(2,)], "x long"), 2)
    send(frame([(2,)], "x long").filter("x > 2"), 2)
    assert [(r.x, r.batch_id) for r in spark.read.parquet(path).collect()] == [(1, 1)]


def test_partition_overwrite_twice_changes_nothing_else(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_partitions(frame([(1, "a"), (2, "b")], "x long, dt string"), path)
    for _ in range(2):
        writers.overwrite_partitions(frame([(9, "b")], "x long, dt string"), path)
    assert sorted((r.x, r.dt) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_checks_route_unknown_outcomes_to_dead_letters(frame):
    df = frame([(1, 5.0), (2, -1.0), (3, None)], "id long, price double")
    checked = ql.check(df, {"price": F.col("price") > 0, "id": F.col("id") != 2})
    assert [r.id for r in ql.valid(checked).collect()] == [1]
    assert [(r.id, r.errors) for r in ql.dead_letters(checked).orderBy("id").collect()] == [("2", ["price", "id"]), ("3", ["price"])]


def test_enforce_types_nulls_misfits(frame):
    got = ql.enforce_types(frame([("12", "x"), ("a", "y")], "n string, m string"), {"n": "int"})
    assert got.columns == ["n"] and [r.n for r in got.collect()] == [12, None]


def test_log_compliance(frame):
    lines = [
        '{"event":"e","job":"a","timestamp":"2024-01-01T00:00:00Z","valid_records":1,"dlq_records":0,"duration_seconds":1.5,"success":true}',
        '{"event":"e","job":"b","timestamp":"2024-01-01T00:00:00Z","valid_records":1,"dlq_records":2,"duration_seconds":1.5,"success":true}',
        '{"event":"e","job":"c","timestamp":"yesterday","valid_records":1,"dlq_records":0,"duration_seconds":1,"success":true}', "not json",
    ]
    got = [(r.missing, r.wrong_success, r.compliant) for r in ql.log_compliance(frame([(x,) for x in lines], "line string")).collect()]
    assert got[:3] == [([], False, True), ([], True, False), ([], False, False)]
    assert len(got[3][0]) == 7 and not got[3][2]


def test_reference_date_skips_weekend(frame):
    days = [(f"2024-03-{d:02d}",) for d in range(1, 12)]
    cal = frame(days, "d string").select(F.col("d").cast("date").alias("day")).withColumn("is_business_day", F.weekday("day") < 5)
    assert str(etl.reference_date(cal, "2024-03-11").first()[0]) == "2024-03-07"
    assert etl.reference_date(cal, "2024-03-02").count() == 0


def test_lookup_rejects_duplicate_keys(frame):
    with pytest.raises(ValueError):
        etl.lookup(frame([(1,)], "k int"), frame([(1, "a"), (1, "b")], "k int, v string"), "k")


def test_csv_columns_by_header_and_records_over_splits(spark, tmp_path):
    import csv
    import random

    rng = random.Random(4)
    cells = ["", "plain", "with, comma", 'say "hi"', "two\nlines", "a\n\n\"\n\"b", "  kept  ", "é,\r\nx", "#"]
    want = []
    for n, names in enumerate((["id", "text", "more"], ["more", "id", "other", "text"], ["text", "id"])):
        rows = [{c: rng.choice(cells) for c in names} | {"id": f"{n}-{i}"} for i in range(400)]
        rows[7]["text"] = "long\n" * 3000  # longer than several splits
        with open(tmp_path / f"{n}.csv", "w", newline="", encoding="utf-8") as f:
            writer = csv.DictWriter(f, names, quoting=csv.QUOTE_ALL, lineterminator="\r\n" if n == 1 else "\n")
            writer.writeheader()
            writer.writerows(rows)
        want += [(r["id"], r.get("text") or None, r.get("more") or None) for r in rows]
    blank = lambda r: tuple(x or None for x in r)
    for size in (700, 1 << 20):
        got = readers.csv_records(spark, str(tmp_path), ["id", "text", "more"], split_bytes=size)
        assert sorted(blank(r) for r in got.collect()) == sorted(want), size
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "700"


def test_long_stage_chain_and_cycle(frame):
    schema = "source_id string, relation string, target_id string"
    edge = lambda a, b: (f"s{a:02d}", "HAPPENS_AFTER", f"s{b:02d}")
    chain = sem.stage_chain(frame([edge(i + 1, i) for i in range(39)] + [edge(20, 5), ("s01", "OTHER", "s02")], schema)).collect()
    assert len(chain) == 40 * 39 // 2 and {(r.distance) for r in chain if (r.stage, r.ancestor) == ("s20", "s05")} == {1}
    assert {(r.distance) for r in chain if (r.stage, r.ancestor) == ("s39", "s00")} == {39 - 14}
    for edges in ([edge(1, 2), edge(2, 3), edge(3, 1), edge(9, 1)], [edge(4, 4)]):
        with pytest.raises(ValueError, match="cycle through s0[14]"):
            sem.stage_chain(frame(edges, schema))
    assert sem.stage_chain(frame([], schema)).count() == 0


def test_wiki_links_are_resolved(frame):
    pages = frame(
        [
            (1, "6 - Notes/Plan.md", "The Plan", ["roadmap"], "see [[Team]] and ![[team#People|the people]] [[ the  plan ]] [[#Here]] [[Nowhere|x]] [[]] [broken](x)"),
            (2, "1 - Stakeholders/Team.md", "Team", None, "[[6 - Notes/plan.md#Goals]] [[ROADMAP]]\n[[not\nclosed]]"),
            (3, "3 - Knowledge/team.md", "Other team", [], "[[./Plan]]"), (4, "Lone.md", "Roadmap", None, None),
        ], "id long, path string, title string, aliases array<string>, body string",
    )
    links = nt.resolve(nt.wiki_links(pages, "id", "body"), nt.page_names(pages, "id", "path", "title", "aliases"), "id")
    got = sorted(((r.id, r.position, r.target, r.part, r.alias, r.embedded, r.page) for r in links.collect()), key=lambda r: r[:2])
    assert got == [
        (1, 0, "Team", None, None, False, 2), (1, 1, "team", "People", "the people", True, 2), (1, 2, "the  plan", None, None, False, 1),
        (1, 3, "", "Here", None, False, 1), (1, 4, "Nowhere", None, "x", False, None),
        (2, 0, "6 - Notes/plan.md", "Goals", None, False, 1), (2, 1, "ROADMAP", None, None, False, 4), (3, 0, "./Plan", None, None, False, 1),
    ]
    assert sorted(r.id for r in nt.without_inbound(pages, "id", links).collect()) == [3]


def test_notes(frame):
    pages = frame([("a", "see [[b]] and [[c|text]]"), ("b", "[[b]]"), ("c", "[[a#part]]"), ("d", "")], "id string, body string")
    found = nt.links(pages, "id", "body")
    assert sorted((r.id, r.target) for r in found.collect()) == [("a", "b"), ("a", "c"), ("b", "b"), ("c", "a")]
    assert [r.id for r in nt.orphans(pages, "id", F.col("id"), found).collect()] == ["d"]
    only_self = found.filter("id = 'b'")
    assert sorted(r.id for r in nt.orphans(pages, "id", F.col("id"), only_self).collect()) == ["a", "b", "c", "d"]
    log = frame([("## [2026-04-02] ingest | Some | title",), ("# other",)], "line string")
    assert tuple(nt.parse_log(log).first())[1:] == ("2026-04-02", "ingest", "Some | title")


def test_kmeans_covers_every_row(spark, frame):
    rows = [(i, [float(i % 3) * 10, float(i % 7) / 10]) for i in range(60)]
    out, centres = cg.kmeans(frame(rows, "vec_id long, embedding array<double>"), k=3)
    near = cg.centre_distance(out, centres)
    assert near.count() == 60 and near.agg(F.max("distancia_centroide")).first()[0] < 1.0
    own = cg.assign_nearest(out.drop("cluster"), centres, "vec_id").join(out.select("vec_id", F.col("cluster").alias("c")), "vec_id")
    assert own.filter("cluster <> c").count() == 0


def test_certificate_notices_a_wrong_clustering(frame):
    rows = [(i, [float(i % 3) * 10, float(i % 7) / 10], i % 3) for i in range(60)]
    centres = frame([(c, [c * 10.0, 0.3]) for c in range(3)], "cluster int, centre array<double>")
    schema = "vec_id long, embedding array<double>, cluster int"
    good = cg.kmeans_certificate(frame(rows, schema), centres).first()
    assert (good.rows, good.misplaced, good.clusters, good.empty) == (60, 0, 3, 0) and good.drift < 0.1
    bad = cg.kmeans_certificate(frame([(i, v, 0 if i < 9 else c) for i, v, c in rows], schema), centres).first()
    assert bad.misplaced == 6 and bad.drift > 0.5
    moved = frame([(0, [0.0, 0.3]), (1, [10.0, 0.3]), (2, [20.0, 0.3]), (3, [99.0, 0.0])], "cluster int, centre array<double>")
    assert cg.kmeans_certificate(frame(rows, schema), moved).first().empty == 1


def test_place_takes_the_lower_cluster_on_ties(frame):
    df = frame([(1, [0.0]), (1, [0.0]), (2, [5.0]), (3, [10.0])], "vec_id long, embedding array<double>")
    centres = frame([(7, [10.0]), (3, [0.0])], "cluster int, centre array<double>")
    assert sorted((r.vec_id, r.cluster) for r in cg.place(df, centres).collect()) == [(1, 3), (1, 3), (2, 3), (3, 7)]


def test_fraud_job_from_text_to_report(spark, frame, tmp_path):
    from tidewright.plans import fraud

    def tx(i, bad):
        return (i, "shop", f"m{i % 5}", "watch" if bad else "bread", "online" if bad else "pos", "nao" if bad else "sim", "alto" if bad else "baixo", "X", "Y",
                3 if bad else 12, 10.0 * (i % 9) + (900 if bad else 0), int(bad))

    schema = ("tx_id long, perfil_simulado string, merchant string, descricao string, canal string, cartao_presente string, risco_device string, "
              "pais string, cidade string, hora int, valor double, fraude int")
    rows = frame([tx(i, i % 5 == 0) for i in range(200)], schema)

    def load_model():  # an embedder that sees what was bought, and how
        return lambda texts: [[10.0 * ("watch" in t), 10.0 * ("online" in t), (len(t) % 7) / 100] for t in texts]

    done = fraud.run(rows, str(tmp_path / "job"), load_model=load_model, clusters=2)
    told = fraud.check(done).first()
    assert (told.transactions, told.frauds, told.unexplained, told.misplaced, told.clusters) == (200, 40, 0, 0, 2)
    report = {r.label: r for r in done.report().collect()}
    assert report["1"].recall == 1.0 and report["1"].precision > 0.85
    worst = done.suspicious(5).collect()
    assert len(worst) == 5 and all(r.fraude == 1 for r in worst) and [r.valor for r in worst] == sorted((r.valor for r in worst), reverse=True)
    assert done.outliers().count() == 15 and done.table("summary").first().fraude_rate == 1.0
    assert done.scored.where("narrativa LIKE 'transação online no merchant m0; descrição watch;%'").count() == 40


@pytest.mark.parametrize("given", [True, False])
def test_fraud_job_stores_no_vectors_beside_the_fit(spark, frame, tmp_path, given):
    from tidewright.plans import fraud

    schema = ("tx_id long, perfil_simulado string, merchant string, descricao string, canal string, cartao_presente string, risco_device string, "
              "pais string, cidade string, hora int, valor double, fraude int")
    rows = frame([(i, "shop", f"m{i % 5}", f"item {i % 11}", "pos", "sim", "baixo", "X", "Y", i % 24, 10.0 * i, int(i % 7 == 0)) for i in range(90)], schema)
    centres = frame([(i, [float(i == j) for j in range(64)]) for i in range(3)], "cluster int, centre array<double>") if given else None
    done = fraud.run(rows, str(tmp_path / "job"), centres=centres, clusters=3)
    assert done.scored.count() == 90 and fraud.check(done).first().transactions == 90
    stored = {p.name: spark.read.parquet(str(p)).columns for p in (tmp_path / "job").iterdir()}
    assert [n for n, columns in stored.items() if "embedding" in columns] == ([] if given else ["embedded"])
    assert fraud.check(done).first().misplaced == 0


def test_projection_keeps_variance(frame):
    rows = [(i, [float(i), 2.0 * i + 5, float(i % 3) / 100]) for i in range(30)]
    fit = cg.Projection(frame(rows, "vec_id long, embedding array<double>"), 2)
    assert fit.variance(1) > 0.999
    xs = fit.coordinates(1).select(F.col("coordinates")[0].alias("x"))
    assert abs(xs.agg(F.avg("x")).first()[0]) < 1e-9  # centred


def test_report_of_missing_class(frame):
    got = {r.label: r for r in cg.classification_report(frame([(0, 0), (0, 0), (1, 0)], "t int, p int"), "t", "p", [0, 1]).collect()}
    assert (got["1"].precision, got["1"].recall, got["1"].support) == (0.0, 0.0, 1)
    assert got["0"].precision == 0.667 and got["accuracy"].f1 == 0.667


TX_SCHEMA = ("tx_id long, perfil_simulado string, merchant string, descricao string, canal string, cartao_presente string, risco_device string, "
             "pais string, cidade string, hora int, valor double, fraude int")


def test_vectors_of_the_fraud_job_are_stored_as_bytes(spark, frame, tmp_path):
    from tidewright.functions.vectors import hash_embedding
    from tidewright.operators.knn_blocks import columns
    from tidewright.plans import fraud

    rows = [(i, "Ágio", f"M{i % 5}", None if i == 17 else f"Item {i % 11} ΑΣ", "pos", "sim", "baixo\t \u0085" if i == 3 else "Baixo \n", "X", "Y", i % 24, 10.0 * i, int(i % 7 == 0)) for i in range(90)]
    done = fraud.run(frame(rows, TX_SCHEMA), str(tmp_path / "job"), clusters=3)
    stored = spark.read.parquet(str(tmp_path / "job" / "embedded"))
    assert dict(stored.dtypes)["embedding"] == "binary" and stored.agg(F.max(F.length("embedding"))).first()[0] == 64
    both = done.placed.join(done.scored.select("tx_id", hash_embedding(F.col("narrativa")).alias("whole")), "tx_id").where("tx_id <> 17").toArrow()
    assert columns(both["embedding"], 64).T.tolist() == both["whole"].to_pylist()  # to the last bit
    told = fraud.check(done).first()
    assert (told.transactions, told.unexplained, told.misplaced, told.clusters) == (90, 0, 0, 3)
    assert done.scored.where("percentil_distancia IS NULL").select("tx_id").collect() == [(17,)]


def test_placed_rows_are_measured_as_the_jvm_does(spark, frame):
    rows = [(i, [float(i % 7), i / 3.0, -0.1 * i]) for i in range(50)] + [(50, None)]
    centres = frame([(4, [1.0, 2.0, 3.0]), (2, [0.3, 9.0, 0.1])], "cluster int, centre array<double>")
    df = frame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in cg.centre_distance(cg.place(df, centres, measured=True), centres).collect()}
    want = {r.vec_id: r for r in cg.centre_distance(cg.place(df, centres), centres).collect()}
    assert len(got) == 51 and all((got[i].cluster, got[i].distancia_centroide) == (want[i].cluster, want[i].distancia_centroide) for i in got)


def test_fit_of_bytes_finds_groups_and_is_a_fit(spark, frame):
    groups = [bytes([40 * g] * 32 + [255 - 40 * g] * 32) for g in range(4)]
    rows = [(i, None if i % 50 == 49 else groups[i % 4][:-1] + bytes([i % 9])) for i in range(400)]
    df = frame(rows, "vec_id long, embedding binary").repartition(5)
    out, centres = cg.kmeans(df, k=4)
    told = cg.kmeans_certificate(out, centres).first()
    assert (told.rows, told.misplaced, told.clusters, told.empty) == (400, 0, 4, 0) and told.drift < 1e-6
    met = {(r.vec_id % 4, r.cluster) for r in out.where("embedding IS NOT NULL").collect()}
    assert len(met) == 4 and "embedding" in out.columns
