"""Pipeline specification: precedence merge, template expansion, validation."""

import pytest

from cdcflow.plans import registry, spec

pytestmark = pytest.mark.usefixtures("spark")  # declared schemas are parsed by Spark

SPEC = """
lv2_processors:
  common:
    failTopic: "err"
    primaryKeyFields: ["user_id"]
    channel: "common-ch"
    targetTemplates: ["T1", "T2"]
    extraKey: 1
  templates:
    - name: "T1"
      destinationTopic: "d1"
      schemaName: "ChannelContact"
      mapperName: "channel_contact"
      pipelineNamePrefix: "P1"
      primaryKeyFields: ["channel", "user_id"]
    - name: "T2"
      destinationTopic: "d2"
      schemaName: "CacheStamp"
      mapperName: "cache_stamp"
      pipelineNamePrefix: "P2"
      primaryKeyFields: ["entity_id"]
  sources:
    - sourceTopic: "s1"
      pipelineNameSuffix: "X"
      channel: null
    - sourceTopic: "s2"
      pipelineNameSuffix: "Y"
      targetTemplates: ["T2"]
      primaryKeyFields: ["data"]
"""


def test_expand_and_merge():
    defs = spec.load(SPEC)["lv2"]
    names = [d["name"] for d in defs]
    assert names == ["P1X", "P2X", "P2Y"]
    p1x = defs[0]
    assert p1x["primaryKeyFields"] == ["channel", "user_id"]  # template overrides common, lists replace
    assert p1x["channel"] == "common-ch"  # null in the source never overrides
    assert p1x["extraKey"] == 1  # unknown keys kept
    assert defs[2]["primaryKeyFields"] == ["data"] and defs[2]["sourceTopic"] == "s2"


def test_all_templates_when_no_targets():
    text = SPEC.replace('    targetTemplates: ["T1", "T2"]\n', "")
    defs = spec.load(text)["lv2"]
    assert len(defs) == 3  # s1 x {T1, T2}, s2 x {T2}


def test_validation_errors():
    with pytest.raises(spec.SpecError, match="has no name"):
        spec.load("lv1_processors:\n  pipelines:\n    - sourceTopic: x\n")
    with pytest.raises(spec.SpecError, match="lacks sourceTopic"):
        spec.load("lv1_processors:\n  pipelines:\n    - name: x\n")
    with pytest.raises(spec.SpecError):
        spec.resolve_group("lv9", {})
    with pytest.raises(spec.SpecError, match="keyFormat placeholders"):
        spec.check_against_schema({"keyType": "String", "keyFormat": "{nope}", "schemaName": "S"}, ["a"])
    with pytest.raises(spec.SpecError, match="Primary key"):
        spec.check_against_schema({"primaryKeyFields": ["zz"], "schemaName": "S"}, ["a"])


def test_sample_spec_is_consistent(spark):
    from cdcflow.plans import samples  # noqa: F401

    defs = spec.load()
    assert [d["name"] for d in defs["lv1"]] == ["RefineCustomers"]
    assert [d["name"] for d in defs["lv2"]] == ["StampsCustomers", "ContactsCustomers", "ContactsSuppliers"]
    for g, ds in defs.items():
        for d in ds:
            schema = registry.get_schema(d["schemaName"], g)
            spec.check_against_schema(d, schema.fieldNames())
            assert registry.get_mapper(g, d["mapperName"])


def test_config_location(tmp_path, monkeypatch):
    p = tmp_path / "p.yml"
    p.write_text("lv1_processors:\n  pipelines:\n    - {name: a, sourceTopic: s, destinationTopic: d, failTopic: f, schemaName: ContactProfile, mapperName: contact_profile}\n")
    assert spec.load(str(p))["lv1"][0]["name"] == "a"
    monkeypatch.setenv(spec.CONFIG_PATH_ENV, str(p))
    assert spec.load()["lv1"][0]["name"] == "a"
    monkeypatch.delenv(spec.CONFIG_PATH_ENV)
    assert spec.load()["lv1"][0]["name"] == "RefineCustomers"
    with pytest.raises(spec.SpecError, match="no pipeline spec"):
        spec.load(str(tmp_path / "missing.yml"))


def test_names_and_keys_are_checked_on_load():
    with pytest.raises(spec.SpecError, match="two pipelines are named"):
        spec.load(SPEC.replace("pipelineNameSuffix: \"Y\"", "pipelineNameSuffix: \"X\""))
    with pytest.raises(spec.SpecError, match="Primary key"):
        spec.load(SPEC.replace('["data"]', '["nope"]'))
    with pytest.raises(spec.SpecError, match="keyFormat placeholders"):
        spec.load(SPEC.replace('primaryKeyFields: ["data"]', 'keyType: "String"\n      keyFormat: "{phone}"'))
    with pytest.raises(spec.SpecError, match="no mapper"):
        spec.load(SPEC.replace('"channel_contact"', '"nobody"'))


def test_mapping_rejects_undeclared_output(spark):
    from cdcflow.operators import mapping as m

    with pytest.raises(ValueError, match="not declared"):
        m.Mapping("x", "a string", [m.json_string("b", "b")])
