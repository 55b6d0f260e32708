import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from wattline.errors import IngestError, OptionError, RegistryError, TrainingError
from wattline.operators.contracts import RAW, Contract
from wattline.operators.models import ModelDefinition
from wattline.plans.compare import Candidate, compare_models, promote_from_results
from wattline.plans.monitor import MonitorOptions, decide_retrain, monitor_job
from wattline.plans.runlog import RunLog
from wattline.plans.score import score_job
from wattline.plans.train import TrainOptions, train_job
from wattline.sources.delimited import (
    ingest_timestamp, normalize_header, read_header, scan_delimited, scan_directory, scan_headerless,
)
from wattline.sources.tables import (
    COMPARISON_SCHEMA, REGISTRY_SCHEMA, REPORT_SCHEMA, RUN_PHASES_SCHEMA, TRIAL_METRICS_SCHEMA, champion, load_champion,
    phase_durations, read_table, register, save_engineered, save_predictions,
)

HEADER = '"";"MT_001";"MT_002"\n'


def meter_file(path, first=0, n=4, header=HEADER, cells=lambda i: f"{i},5;{i}"):
    path.write_text(header + "".join(f'"{at(first + i)}";{cells(i)}\n' for i in range(n)))
    return str(path)


def test_scan_reads_types_and_the_blank_header(spark, tmp_path):
    path = meter_file(tmp_path / "a.txt")
    df = scan_delimited(spark, path, Contract(RAW))
    assert df.columns == ["Unnamed: 0", "MT_001", "MT_002"] == read_header(spark, path)
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(ingest_timestamp(df), "timestamp")[1] == (at(1), "1,5", "1")
    with pytest.raises(IngestError):
        scan_delimited(spark, f"{tmp_path}/none.txt")


def test_scan_parses_a_timestamp_column(spark, tmp_path):
    path = meter_file(tmp_path / "a.txt", header="timestamp;MT_001;MT_002\n")
    assert dict(scan_delimited(spark, path, Contract({"MT_002": "int64"})).dtypes) == {"timestamp": "timestamp_ntz", "MT_001": "string", "MT_002": "bigint"}


def test_files_with_swapped_columns_fail_the_typed_scan(spark, tmp_path):
    meter_file(tmp_path / "a.txt", header="timestamp;MT_001;MT_002\n")
    meter_file(tmp_path / "b.txt", header="timestamp;MT_002;MT_001\n")
    with pytest.raises(Exception, match="header"):
        scan_delimited(spark, f"{tmp_path}/*.txt").collect()


def test_directory_scan_matches_columns_by_name(spark, tmp_path):
    meter_file(tmp_path / "a.txt", n=1, cells=lambda i: "1;2")
    meter_file(tmp_path / "b.csv", n=1, header='"";"MT_002";"MT_001"\n', cells=lambda i: "2;1")
    (tmp_path / "c.json").write_text("{}")
    got = scan_directory(spark, str(tmp_path)).select("source_file", "MT_001", "MT_002")
    assert rows(got, "source_file") == [("a.txt", "1", "2"), ("b.csv", "1", "2")]
    (tmp_path / "empty").mkdir()
    assert scan_directory(spark, f"{tmp_path}/empty") is None


def test_ingest_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("soon", 2), (None, 3)], "when string, n int")
    assert [r[0] for r in ingest_timestamp(df, strict=False).orderBy("n").collect()] == [at(0), None, None]
    with pytest.raises(Exception, match="soon"):
        ingest_timestamp(df).collect()


@pytest.mark.parametrize("first", ["", "_c0", "Unnamed: 0", "timestamp", '"timestamp"'])
def test_header_names(spark, first):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1)], "a string, b int").toDF(first, '"MT_001"')
    assert normalize_header(df).dtypes == [("timestamp", "timestamp_ntz"), ("MT_001", "int")]


def test_header_without_timestamp(spark):
    with pytest.raises(IngestError):
        normalize_header(spark.createDataFrame([(1,)], "a int"))


def test_headerless_scan_skips_a_header_line(spark, tmp_path):
    got = scan_headerless(spark, meter_file(tmp_path / "a.txt", n=2, cells=lambda i: f"{i},5;x"))
    assert rows(got, "timestamp") == [(at(0), 0.5, None), (at(1), 1.5, None)]


def test_leading_blank_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text(f"\n \t\n{at(0)};1;2\n\n{at(1)};3;4\n")
    (tmp_path / "b.txt").write_text(f"{at(2)};5;6\n")
    (tmp_path / "c.txt").write_text("\n\n")
    got = scan_headerless(spark, f"{tmp_path}/*.txt").select("client_1", "client_2")
    assert sorted(map(tuple, got.collect())) == [(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)]
    folder = tmp_path / "headed"
    folder.mkdir()
    meter_file(folder / "a.txt", n=2, header="\n  \n" + HEADER)
    meter_file(folder / "b.csv", n=1, header='\n"";"MT_002";"MT_001"\n', cells=lambda i: "8;9")
    (folder / "blank.txt").write_text("\n \n")
    got = scan_directory(spark, str(folder)).select("source_file", "MT_001", "MT_002")
    assert sorted(map(tuple, got.collect())) == [("a.txt", "0,5", "0"), ("a.txt", "1,5", "1"), ("b.csv", "9", "8")]
    only = tmp_path / "only"
    only.mkdir()
    (only / "blank.txt").write_text("\n \n")
    assert scan_directory(spark, str(only)).count() == 0


def test_headerless_scan_keeps_rows_without_timestamp(spark, tmp_path):
    (tmp_path / "a.txt").write_text("timestamp;MT_001;MT_002\n2024-01-01 00:00:00;1;2\n;2,5;x\n;;\n")
    (tmp_path / "b.txt").write_text(";7;\n2024-01-01 00:15:00;3;4\n")
    got = scan_headerless(spark, [f"{tmp_path}/a.txt", f"{tmp_path}/b.txt"])
    found = sorted([tuple(r) for r in got.collect()], key=repr)
    assert found == sorted([(at(0), 1.0, 2.0), (None, 2.5, None), (None, None, None), (None, 7.0, None), (at(1), 3.0, 4.0)], key=repr)


def test_directory_scan_of_many_files(spark, tmp_path):
    for i in range(1100):
        names, cells = (("A", "B"), "1;2") if i % 2 else (("B", "A"), "2;1")
        (tmp_path / f"f{i}.txt").write_text(f'"";"MT_{names[0]}";"MT_{names[1]}"\n"{at(0)}";{cells}\n')
    got = scan_directory(spark, str(tmp_path)).groupBy("MT_A", "MT_B").agg(F.countDistinct("source_file").alias("n")).collect()
    assert [tuple(r) for r in got] == [("1", "2", 1100)]


def test_scoring_keeps_other_sources(spark, tmp_path):
    for source in ("a", "b", "a"):
        save_predictions(spark.createDataFrame([(source, 1.0)], "source_file string, prediction double"), f"{tmp_path}/p")
    assert sorted(r["source_file"] for r in spark.read.parquet(f"{tmp_path}/p").collect()) == ["a", "b"]


def test_engineered_sink(spark, tmp_path):
    df = spark.createDataFrame([(at(0), 1.5)], "timestamp timestamp_ntz, total_load double")
    for _ in range(2):
        path = save_engineered(df, f"{tmp_path}/t")
    assert rows(spark.read.parquet(path)) == [(at(0), 1.5)]
    text = save_engineered(df, f"{tmp_path}/c", "csv")
    assert rows(spark.read.option("header", True).schema(df.schema).csv(text)) == [(at(0), 1.5)]
    with pytest.raises(OptionError):
        save_engineered(df, f"{tmp_path}/x", "xlsx")


def test_registry_counts_versions_as_numbers(spark, tmp_path):
    path = f"{tmp_path}/registry"
    with pytest.raises(RegistryError):
        load_champion(spark, path)
    assert [register(spark, path, f"m{i}", "p", {"rmse": 9.0 - i}, "now") for i in range(3)] == ["v1", "v2", "v3"]
    assert load_champion(spark, path)["model_name"] == "m2"
    many = spark.createDataFrame([(f"v{i}", "m", "p", {}, "champion", "t") for i in (1, 9, 10, 2)], REGISTRY_SCHEMA)
    assert champion(many).first()["version"] == "v10"


def test_run_log_is_written_on_failure(spark, tmp_path):
    path = f"{tmp_path}/runs"
    with pytest.raises(ValueError):
        with RunLog(spark, path, "job", {"a": 1}) as log:
            with log.phase("one"):
                pass
            with log.phase("two"):
                raise ValueError("no")
    table = read_table(spark, path, RUN_PHASES_SCHEMA)
    assert rows(table.select("phase", "status", "error_message", "run_status"), "phase") == [("one", "SUCCESS", None, "FAILED"), ("two", "FAILED", "no", "FAILED")]
    summary = phase_durations(table).first()
    assert (summary["run_status"], summary["n_phases"], summary["n_failed"]) == ("FAILED", 2, 1)


def raw_table(spark, n=1500, first=0, level=1):
    # some noise, since a baseline error of zero can never drift
    data = [(str(at(first + i)), f"{level * (i // 4 % 24) + i * 7 % 5},25", "1" if i % 5 else None) for i in range(n)]
    return spark.createDataFrame(data, "`Unnamed: 0` string, MT_001 string, MT_002 string")


MODELS = [
    ModelDefinition("net", "elastic_net", {"alpha": 0.1}),
    ModelDefinition("forest", "random_forest_regressor", {"n_estimators": 3, "max_depth": 6}),
]


def test_train_score_and_monitor(spark, tmp_path):
    base = str(tmp_path / "run")
    options = TrainOptions(base, train_end="2024-01-10", val_end="2024-01-13", definitions=MODELS, training_params={"epochs": "1"})
    result = train_job(raw_table(spark), options)
    assert result.version == "v1" and result.best.metrics["rmse"] == min(t.metrics["rmse"] for t in result.trials)
    assert read_table(spark, f"{base}/trial_metrics", TRIAL_METRICS_SCHEMA).count() == 2
    assert read_table(spark, f"{base}/run_phases", RUN_PHASES_SCHEMA).where("status = 'SUCCESS'").count() == 3

    files = tmp_path / "files"
    files.mkdir()
    meter_file(files / "a.txt", n=8)
    meter_file(files / "b.csv", first=100, n=5)
    out = score_job(spark, str(files), f"{base}/registry", f"{base}/predictions")
    got = spark.read.parquet(out)
    assert rows(got.groupBy("source_file").count(), "source_file") == [("a.txt", 8), ("b.csv", 5)]
    assert got.where("prediction is null").isEmpty()
    (tmp_path / "none").mkdir()
    assert score_job(spark, f"{tmp_path}/none", f"{base}/registry", f"{base}/predictions2") is None

    watch = MonitorOptions(f"{base}/registry", f"{base}/reports", f"{base}/run_phases", live_after="2024-01-13")
    with pytest.raises(RegistryError):
        decide_retrain(spark, f"{base}/reports")
    assert monitor_job(raw_table(spark, level=3), watch) is True
    assert decide_retrain(spark, f"{base}/reports").first()["retrain_required"] is True
    report = read_table(spark, f"{base}/reports", REPORT_SCHEMA).first()
    assert report["model_version"] == "v1" and report["live_metrics"]["rmse"] > report["baseline_metrics"]["rmse"]


def test_failed_training_leaves_a_log(spark, tmp_path):
    options = TrainOptions(str(tmp_path), train_end="2024-01-10", val_end="2024-01-13", definitions=[ModelDefinition("bad", "elastic_net", {"alpha": -1})])
    with pytest.raises(TrainingError):
        train_job(raw_table(spark), options)
    failed = read_table(spark, f"{tmp_path}/run_phases", RUN_PHASES_SCHEMA).where("status = 'FAILED'")
    assert rows(failed.select("phase")) == [("model_search",)]


def test_comparison_and_promotion(spark, tmp_path):
    df = spark.createDataFrame([(i, float(3 * i)) for i in range(50)], "x int, total_load double")
    flat = ModelDefinition("flat", "elastic_net", {"alpha": 1e9})
    winner, trials = compare_models(df, df, ["x"], flat, MODELS[:1], reports=f"{tmp_path}/c", registry=f"{tmp_path}/r")
    assert winner.model_id == "net" and len(trials) == 2
    report = read_table(spark, f"{tmp_path}/c", COMPARISON_SCHEMA)
    assert rows(report.select("model_id", "role", "is_champion"), "model_id") == [("flat", "baseline", False), ("net", "candidate", True)]
    assert load_champion(spark, f"{tmp_path}/r")["model_name"] == "net"


def test_promotion_from_given_results(spark):
    base = Candidate("base", {"rmse": 2.0}, "p")
    assert promote_from_results(spark, base, [Candidate("tie", {"rmse": 2.0}, "p")]).model_id == "base"
    assert promote_from_results(spark, base, [Candidate("a", {"rmse": 1.0}, "p"), Candidate("b", {"rmse": 1.0}, "p")]).model_id == "a"
    with pytest.raises(TrainingError):
        promote_from_results(spark, base, [Candidate("nan", {"rmse": float("nan")}, "p")])
    with pytest.raises(TrainingError):
        promote_from_results(spark, base, [Candidate("gone", {"mse": 1.0}, "p")])


def test_headerless_files_of_three_widths(spark, tmp_path):
    (tmp_path / "a.txt").write_text(f"{at(0)};1;2\n{at(1)};3;4\n")
    (tmp_path / "b.txt").write_text(f"{at(2)};5;6;7\n{at(3)};8\n")
    # a line inside a file is the widest of all, and a quoted cell holds a separator
    (tmp_path / "c.txt").write_text(f'{at(4)};9\n{at(5)};10;"x;y";11;12\n')
    got = scan_headerless(spark, f"{tmp_path}/*.txt")
    assert got.columns == ["timestamp", "client_1", "client_2", "client_3", "client_4"]
    assert rows(got, "timestamp") == [
        (at(0), 1.0, 2.0, None, None), (at(1), 3.0, 4.0, None, None), (at(2), 5.0, 6.0, 7.0, None), (at(3), 8.0, None, None, None),
        (at(4), 9.0, None, None, None), (at(5), 10.0, None, 11.0, 12.0),
    ]


def test_one_scan_for_many_headers(spark, tmp_path):
    for i, order in enumerate((("A", "B", "C"), ("C", "A"), ("B",), ("C", "B", "A"))):
        header = ";".join(f'"MT_{n}"' for n in order)
        (tmp_path / f"f{i}.txt").write_text(f'"";{header}\n"{at(i)}";' + ";".join(f"{n}{i}" for n in order) + "\n")
    got = scan_directory(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    found = got.select("source_file", "MT_A", "MT_B", "MT_C").orderBy("source_file").collect()
    assert [tuple(r) for r in found] == [("f0.txt", "A0", "B0", "C0"), ("f1.txt", "A1", None, "C1"), ("f2.txt", None, "B2", None), ("f3.txt", "A3", "B3", "C3")]
