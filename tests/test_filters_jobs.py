import pytest

from mirrorkit.operators.filters import apply_predicate, job_predicate
from mirrorkit.plans.job import (
    MirrorJob, TableDefinition, check_batch, derive_job, job_from_spec, lint_batch, lint_job, load_batch_specs,
    load_predicates, mirror_name,
)

ROWS = [(1995, "Y"), (1996, "N"), (1997, "D"), (None, "Y"), (1996, None), (1998, "X")]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(ROWS, "taxyr int, cur string")


def count(df):
    return df.count()


def test_year_cur_none_default(frame):
    assert count(apply_predicate(frame, job_predicate((1995, 1996), None))) == 3
    assert count(apply_predicate(frame, job_predicate(None, ("Y",)))) == 2
    assert count(apply_predicate(frame, job_predicate((1995, 1997), ("Y", "D")))) == 2
    assert count(apply_predicate(frame, job_predicate(None, None))) == len(ROWS)
    # Default filter drops null years and null statuses (three-valued logic).
    assert count(apply_predicate(frame, job_predicate((1800, 2026), ("Y", "N", "D")))) == 3


def test_spec_absent_vs_null():
    job = job_from_spec("j", {"table_name": "db.addn"}, predicate_sets={"default": ["a", "b"]},
                        current_year=2024)
    assert job.years == (1800, 2024) and job.cur == ("Y", "N", "D") and job.predicates == ("a", "b")
    assert job.partitions == ("taxyr", "cur") and job.mirror_name == "addn"
    plain = job_from_spec("p", {"table_name": "db.t", "min_year": None, "max_year": None, "cur": None,
                                "predicates_path": None})
    assert plain.years is None and plain.cur is None and plain.predicates is None and plain.partitions == ()
    assert plain.predicate is None


def test_spec_traps():
    with pytest.raises(ValueError):  # reversed years would silently mean "everything"
        job_from_spec("j", {"table_name": "t", "min_year": 2010, "max_year": 2000, "predicates_path": None})
    with pytest.raises(ValueError):  # empty cur likewise
        job_from_spec("j", {"table_name": "t", "cur": [], "predicates_path": None})
    with pytest.raises(ValueError):
        job_from_spec("j", {"table_name": "t", "cur": "Y", "predicates_path": None})
    with pytest.raises(ValueError):
        job_from_spec("j", {"min_year": 2020})
    with pytest.raises(ValueError):
        job_from_spec("j", {"table_name": "t", "min_year": "twenty", "predicates_path": None})
    coerced = job_from_spec("j", {"table_name": "t", "min_year": "2023", "predicates_path": None},
                            current_year=2024)
    assert coerced.years == (2023, 2024)
    one_null = job_from_spec("j", {"table_name": "t", "max_year": None, "predicates_path": None})
    assert one_null.years is None and one_null.partitions == ("cur",)


def test_description_and_overrides():
    defs = {"addrindx": TableDefinition.from_spec({"min_year": 1999, "has_cur": True, "has_parid": True,
                                                   "schema_overrides": {"xcoord": "DECIMAL(15,8)"}})}
    job = job_from_spec("a", {"table_name": "db.addrindx", "min_year": 2011, "max_year": 2013,
                              "cur": ["Y"], "predicates_path": None}, table_definitions=defs)
    assert job.description == "db.addrindx, taxyr=[2011, 2013], cur=[Y]"
    assert job.overrides == {"deactivat": "STRING", "taxyr": "INTEGER", "xcoord": "DECIMAL(15,8)"}


def test_derive_and_lint():
    definition = TableDefinition(min_year=1999, has_cur=False, has_parid=True)
    job = derive_job("d", "db.cvleg", definition, default_predicates=["x"], current_year=2025)
    assert job.years == (1999, 2025) and job.cur is None and job.predicates == ("x",)
    assert lint_job(job, definition) == []
    bad = MirrorJob("b", "db.cvleg", (1990, 2000), ("Y",), None)
    issues = lint_job(bad, definition)
    assert any("cur" in i for i in issues) and any("1990" in i for i in issues)


def test_duplicate_tables_rejected():
    jobs = [MirrorJob("a", "db.t"), MirrorJob("b", "other.t")]
    with pytest.raises(ValueError):
        check_batch(jobs)
    assert mirror_name("a.b.c") == "b.c"


def test_predicate_file_and_batch_specs(tmp_dir):
    from pathlib import Path
    p = Path(tmp_dir) / "chunks.sql"
    p.write_text("parid < '1'\nparid >= '1'\n")
    assert load_predicates(p) == ("parid < '1'", "parid >= '1'")
    p.write_text("parid < '1'\n\nparid >= '1'\n")
    with pytest.raises(ValueError):
        load_predicates(p)
    y = Path(tmp_dir) / "jobs.yaml"
    y.write_text("addn:\n  table_name: db.addn\n  min_year: 2023\n")
    assert load_batch_specs(str(y)) == {"addn": {"table_name": "db.addn", "min_year": 2023}}
    assert load_batch_specs('{"a": {"table_name": "t"}}') == {"a": {"table_name": "t"}}


def test_batch_prefix_lint():
    jobs = [MirrorJob("a", "prod.a"), MirrorJob("b", "prod.b"), MirrorJob("c", "test.c"), MirrorJob("d", "d")]
    issues = lint_batch(jobs)
    assert len(issues) == 1 and "'test.c'" in issues[0]


def test_partition_scope_on_manifest_values(spark):
    job = MirrorJob("j", "t", (1996, 1997), ("Y",))
    df = spark.createDataFrame([("1996", "Y"), ("1998", "Y"), ("1997", "N")], "taxyr string, cur string")
    assert [tuple(r) for r in df.where(job.partition_scope).collect()] == [("1996", "Y")]
    assert MirrorJob("p", "t").partition_scope is None


def test_jobs_from_specs_rejects_same_mirror():
    from mirrorkit.plans.job import jobs_from_specs
    specs = {"a": {"table_name": "x.t", "predicates_path": None}, "b": {"table_name": "y.t", "predicates_path": None}}
    with pytest.raises(ValueError):
        jobs_from_specs(specs)
    jobs = jobs_from_specs({"a": {"table_name": "x.t", "predicates_path": None}}, current_year=2020)
    assert jobs[0].years == (1800, 2020)


def test_config_files_drive_jobs(tmp_dir):
    from pathlib import Path
    from mirrorkit.plans.job import global_overrides_from_config, table_definitions_from_config
    defs_file = Path(tmp_dir) / "tables.yaml"
    defs_file.write_text(
        "define:\n  first: &first 2001\n"
        "tables:\n"
        "  parcels:\n    min_year: *first\n    has_cur: true\n    has_parid: true\n"
        "    schema_overrides:\n      XCOORD: DECIMAL(15,8)\n"
        "  codes:\n    min_year: null\n    has_cur: false\n    has_parid: false\n"
    )
    settings_file = Path(tmp_dir) / "settings.yaml"
    settings_file.write_text("global_schema_overrides:\n  taxyr: INTEGER\n")
    defs = table_definitions_from_config(load_batch_specs(str(defs_file)))
    assert defs["parcels"].min_year == 2001 and defs["codes"].has_cur is False
    overrides = global_overrides_from_config(load_batch_specs(str(settings_file)))
    job = job_from_spec("p", {"table_name": "src.parcels", "predicates_path": None},
                        table_definitions=defs, global_overrides=overrides)
    assert job.overrides == {"taxyr": "INTEGER", "xcoord": "DECIMAL(15,8)"}
    assert lint_job(job, defs["parcels"])  # default min year 1800 is before 2001
