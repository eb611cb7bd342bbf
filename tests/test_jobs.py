from __future__ import annotations

import pytest

from conftest import SF_DIR
from peopleflow import jobs
from peopleflow.operators.synth import generate_people
from peopleflow.plans import inputs
from peopleflow.sinks.exports import export_people
from peopleflow.sources.files import read_json
from peopleflow.sources.topics import write_replay


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("jobs")
    export_people(generate_people(spark, 300), str(path))
    write_replay(inputs.full_log(spark, SF_DIR), str(path / "log"), 2)
    return path


def run(spark, *argv: str) -> None:
    args = jobs.parser().parse_args([str(a) for a in argv])
    args.run(spark, args)


def test_table_jobs(spark, folder, capsys):
    people = folder / "personas.json"
    run(spark, "words", "--input", people)
    run(spark, "files", "--json", people, "--csv", folder / "personas.csv")
    run(spark, "reports", "--input", people)
    run(spark, "timing", "--input", people)
    shown = capsys.readouterr().out
    for title in ("Most frequent words", "CSV columns", "Filters", "People by state", "Groups"):
        assert title in shown


def test_generate(spark, tmp_path):
    run(spark, "generate", "--count", 60, "--out", tmp_path / "g")
    assert read_json(spark, str(tmp_path / "g" / "personas.json")).count() == 60


def test_consume_and_monitor(spark, folder, tmp_path, capsys):
    log = folder / "log"
    run(spark, "consume", "--replay", log, "--total", 40, "--out", tmp_path / "first")
    run(spark, "consume", "--replay", log, "--out", tmp_path / "all")
    run(spark, "consume", "--replay", log, "--checkpoint", tmp_path / "cp", "--out", tmp_path / "st")
    sizes = {n: read_json(spark, str(tmp_path / n / "personas.json")).count() for n in ("first", "all", "st")}
    assert sizes == {"first": 40, "all": 150, "st": 150}
    run(spark, "monitor", "--replay", log, "--limit", 3)
    run(spark, "monitor", "--replay", log, "--limit", 0, "--out", tmp_path / "lines")
    assert spark.read.text(str(tmp_path / "lines")).count() == 3670
    with pytest.raises(SystemExit):
        run(spark, "monitor", "--replay", log, "--limit", 0)
    run(spark, "live", "--replay", log, "--every", "")


def test_options_that_exclude_each_other_are_errors(spark, tmp_path):
    for job in (
        ["produce", "--brokers", "none:1", "--delay", 1],
        ["produce", "--brokers", "none:1", "--delay", 1, "--checkpoint", tmp_path / "cp", "--total", 3],
    ):
        with pytest.raises(SystemExit, match="--total"):
            run(spark, *job)


def test_a_total_of_nothing_is_an_error(capsys):
    for job in ("produce --brokers x:1 --total 0", "consume --replay x --out y --total 0"):
        with pytest.raises(SystemExit):
            jobs.parser().parse_args(job.split())
        assert "from 1 on" in capsys.readouterr().err


def test_consume_goes_on_to_a_larger_total(spark, folder, tmp_path, capsys):
    def ids(name, total):
        args = ("--replay", folder / "log", "--checkpoint", tmp_path / "cp", "--total", total)
        run(spark, "consume", *args, "--out", tmp_path / name)
        return sorted(r[0] for r in read_json(spark, str(tmp_path / name / "personas.json")).select("id_persona").collect())

    assert ids("one", 40) == list(range(1, 41))
    assert ids("again", 40) == list(range(1, 41))
    assert ids("two", 90) == list(range(1, 91))
    assert ids("all", 1000) == list(range(1, 151))


def test_jobs_remove_what_they_staged(spark, folder, tmp_path, monkeypatch):
    dropped = []
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    monkeypatch.setattr(jobs, "drop_staged", dropped.append)
    jobs.main(["monitor", "--replay", str(folder / "log"), "--limit", "2"])
    with pytest.raises(SystemExit):
        jobs.main(["monitor", "--replay", str(folder / "log"), "--limit", "0"])
    assert dropped == [spark, spark]
