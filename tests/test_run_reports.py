"""The command line, in the session of the tests."""

import pytest

import run_reports


@pytest.mark.parametrize("api", ["frame", "sql", "lines"])
def test_all_ways_print_the_busiest_carrier(spark, fixture_folder, tmp_path, capsys, api):
    run_reports.main([fixture_folder, "--api", api, "--land", str(tmp_path / "first")])
    direct = capsys.readouterr().out
    run_reports.main(
        [fixture_folder, "--api", api, "--land", str(tmp_path / "landed"), "--output", str(tmp_path / "out")]
    )
    published = capsys.readouterr().out
    for printed in (direct, published):
        assert "|DL        |6            |" in printed
    assert (tmp_path / "out" / "worst_airports").is_dir()


@pytest.mark.parametrize("given", [[], ["--api", "sql", "--output", "out"]])
def test_files_are_never_read_once_per_report(given):
    with pytest.raises(SystemExit):
        run_reports.parse_arguments(["in", *given])
