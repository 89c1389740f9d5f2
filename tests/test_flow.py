"""The complete flow, file-level training and keyed scoring on small stored tables."""

import pytest
from test_models import RECIPE

from tabwright.errors import ValidationFailure
from tabwright.operators.clean import CleaningSpec
from tabwright.operators.duplicates import distinct_rows, repeated_rows
from tabwright.operators.split import SplitSpec
from tabwright.operators.train import TrainSpec
from tabwright.operators.validate import ValidationRules
from tabwright.plans.flow import run_flow
from tabwright.plans.inference import run_inference
from tabwright.plans.training import read_split, train_path
from tabwright.sources.files import read_json
from tabwright.sources.tables import read_table, write_table

RULES = ValidationRules(target_column="status", required_columns=("company_id", "status"))


@pytest.fixture(scope="module")
def flow(spark, companies, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("flow"))
    write_table(companies, f"{base}/source.parquet")
    done = run_flow(
        spark, f"{base}/source.parquet", f"{base}/out", RULES, CleaningSpec(), RECIPE,
        SplitSpec(seed=17), TrainSpec("status"), before=RULES, gate_metric="accuracy", gate_minimum=0.5,
    )
    return base, done


def test_flow_packages_its_decision(spark, flow):
    base, done = flow
    package = read_json(spark, done.package_path)
    assert package["gate"] == done.decision and len(package["model_sha256"]) == 64
    assert package["gate"]["decision"] == ("approved" if done.decision["metric_value"] >= 0.5 else "rejected")
    assert package["test_metrics"]["accuracy"] == done.training.evaluation["metrics"]["accuracy"]


def test_flow_stops_at_the_raw_check(spark, companies, tmp_path):
    write_table(companies.drop("status"), f"{tmp_path}/source.parquet")
    with pytest.raises(ValidationFailure):
        run_flow(
            spark, f"{tmp_path}/source.parquet", f"{tmp_path}/out", RULES, CleaningSpec(), RECIPE,
            SplitSpec(seed=17), TrainSpec("status"), before=RULES,
        )


def test_file_training_finds_the_sibling(spark, flow, tmp_path):
    _, done = flow
    features = f"{flow[0]}/out/features.parquet"
    for name in ("train", "validation"):
        write_table(read_split(spark, features, name), f"{tmp_path}/my_{name}.parquet")
    spec = TrainSpec("status", max_iter=20)
    train = f"{tmp_path}/my_train.parquet"
    assert train_path(spark, train, f"{tmp_path}/m1", f"{tmp_path}/r1.json", spec).evaluation_dataset == "validation"
    other = f"{tmp_path}/alone.parquet"
    write_table(read_split(spark, features, "train"), other)
    alone = train_path(spark, other, f"{tmp_path}/m2", f"{tmp_path}/r2.json", spec)
    assert alone.evaluation_dataset == "training" and alone.warnings
    with pytest.raises(FileNotFoundError):
        train_path(spark, train, f"{tmp_path}/m3", f"{tmp_path}/r3.json", spec, validation=f"{tmp_path}/no.parquet")


def test_inference_keeps_the_keys(spark, flow, tmp_path):
    base, done = flow
    out = run_inference(
        spark, f"{base}/source.parquet", f"{base}/out/model", f"{base}/out/manifest.json",
        f"{tmp_path}/scored.parquet", include_input=False, key_columns=("company_id",),
    )
    scored = read_table(spark, out.output)
    assert scored.columns[:2] == ["company_id", "predicted_status"]
    assert scored.select("company_id").distinct().count() == 24


def test_many_shared_hashes_group_whole_rows(spark, monkeypatch):
    from tabwright.operators import duplicates

    monkeypatch.setattr(duplicates, "BROADCAST_ROWS", 1)
    df = spark.createDataFrame([(i % 5, None) for i in range(20)] + [(9, "x")], "a int, b string")
    assert sorted((r.a, r.copies) for r in repeated_rows(df).collect()) == [(i, 4) for i in range(5)]
    assert distinct_rows(df).count() == 6
