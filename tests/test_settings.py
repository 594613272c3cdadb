"""Nested settings: defaults, checks, overrides, round trips."""

import json
import re

import pytest

from axonlake.plans import config, settings
from axonlake.plans.config import Config


def test_every_field_has_its_place():
    def leaves(s):
        return [x for v in s.values() for x in (leaves(v) if isinstance(v, dict) else [v[0]])]

    assert sorted(leaves(settings.SCHEMA)) == sorted(Config().__dict__) and set(settings.PATHS) <= set(Config().__dict__)


def test_round_trip(tmp_path, capsys):
    c = settings.config({"inputs": {"points": "p", "regions": {"roisets": ["a"]}}, "outputs": {"graph": {"high-accuracy": 1}, "reports": None}, "job": {"tag": "v3", "output": "hdfs://x/o"}}, "/base")
    assert (c.points, c.partners, c.output, c.tag, c.high_accuracy, c.roisets) == ("/base/p", "", "hdfs://x/o", "v3", 1.0, ["a"])
    assert settings.config(json.loads(settings.resolved(c))) == c and settings.config({}) == Config()
    (tmp_path / "c.json").write_text(json.dumps({"job": {"tag": "v1"}, "inputs": {"points": "x/points"}}))
    assert config.main([str(tmp_path / "c.json"), "-r", "-s", "outputs.graph.node-files=7", "-s", "job.tag=v2", "-s", "outputs.flat.property-names.a=b"]) == 0
    got = json.loads(capsys.readouterr().out)
    assert got["outputs"]["graph"]["node-files"] == 7 and got["job"]["tag"] == "v2" and got["outputs"]["flat"]["property-names"] == {"a": "b"} and got["inputs"]["points"] == f"{tmp_path}/x/points"
    for option, want in (("-t", "v1"), ("-f", "snapshot")):
        config.main([str(tmp_path / "c.json"), option])
        assert capsys.readouterr().out.strip() == want
    config.main(["-d"])
    assert settings.config(json.loads(capsys.readouterr().out)) == Config()
    config.main(["-m"])
    assert json.loads(capsys.readouterr().out)["voxelUnits"] == "nanometers"
    config.main(["-y"])
    text = capsys.readouterr().out
    assert "  graph:" in text and re.search(r"# at most so many batches of segments\n    node-files: 100", text)


@pytest.mark.parametrize(
    "given, said",
    [
        ({"inputs": {"pionts": "x"}}, "inputs.pionts"),
        ({"inputs": {"regions": {"roisets": "a"}}}, "inputs.regions.roisets must be list, not str"),
        ({"outputs": {"graph": []}}, "outputs.graph must be a section"),
        ({"outputs": {"graph": {"node-files": True}}}, "must be int, not bool"),
        ({"outputs": {"graph": {"node-files": 0}}}, "at least 1"),
        ({"outputs": {"graph": {"format": "xml"}}}, "no such format"),
        ({"outputs": {"reports": {"bodies": "some"}}}, "no such choice"),
        ({"outputs": {"reports": {"subsets": {"s": ["a"]}}}}, "unknown reports"),
        ({"other": 1}, "other"),
    ],
)
def test_errors_say_where(tmp_path, given, said):
    with pytest.raises(ValueError, match=said):
        settings.config(given)


def test_overrides_that_fail():
    for text in ("job.tag", "job.tag.x=1"):
        with pytest.raises(ValueError):
            settings.config(settings.override({"job": {"tag": "v"}}, [text]))


def test_flat_files_still_load(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"points": "p", "tag": "v1"}))
    assert Config.load(str(tmp_path / "c.json")) == Config(points="p", tag="v1")
    (tmp_path / "d.json").write_text(json.dumps({"points": "p", "nothing": 1}))
    with pytest.raises(ValueError, match="nothing"):
        Config.load(str(tmp_path / "d.json"))
