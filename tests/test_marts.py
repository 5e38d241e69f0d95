"""Models over hand-written FHIR documents with hand-derived results."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assaylake import EngineConfig
from assaylake.config import LOINC_URI
from assaylake.functions.fingerprint import fingerprint64
from assaylake.functions.scalars import surrogate_key
from assaylake.plans import analyses
from assaylake.plans.lookups import codes
from assaylake.plans.marts import measurement_since
from assaylake.sources import seeds

UPDATED = "2024-01-01T00:00:00Z"


def resource(kind, key, updated=UPDATED, **members):
    return {"resourceType": kind, "id": key, "meta": {"lastUpdated": updated}, **members}


def patient(key, updated=UPDATED, **members):
    return resource("Patient", key, updated, **members)


def observation(key, subject="Patient/p", category="laboratory", updated=UPDATED, **members):
    members.setdefault("effectiveDateTime", "2024-01-01T10:00:00Z")
    flag = {"category": [{"coding": [{"code": category}]}]} if category else {}
    return resource("Observation", key, updated, subject={"reference": subject}, **flag, **members)


def loinc(code):
    return {"coding": [{"system": LOINC_URI, "code": code}]}


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_newest_version_wins(workspace):
    later = ("2024-01-03", "f")
    ws = workspace(
        {
            "Patient": [
                patient("a", gender="male"),
                patient("a", "2024-02-01T00:00:00Z", gender="female"),
                (patient("b", gender="male"), "2024-01-02", "f"),
                (patient("b", gender="female"), *later),
                {"resourceType": "Patient", "id": "c", "gender": "male"},
                patient("c", gender="female"),
                (patient("d", gender="male"), "2024-01-02", "f1"),
                (patient("d", gender="female"), "2024-01-02", "f2"),
            ]
        }
    )
    got = by(ws.model("stg_patient"), "fhir_patient_id")
    assert {k: r.gender for k, r in got.items()} == dict.fromkeys("abcd", "female")


def test_split_follows_the_newest_version_and_loses_nothing(workspace):
    ws = workspace(
        {
            "Observation": [
                observation("was-lab"),
                observation("was-lab", category="vital-signs", updated="2024-02-01T00:00:00Z"),
                observation("none", category=None),
                observation("lab"),
            ]
        }
    )
    lab = {r[0] for r in ws.model("stg_observation_lab").select("fhir_observation_id").collect()}
    other = {r[0] for r in ws.model("stg_observation_nonlab").select("fhir_observation_id").collect()}
    assert lab == {"lab"} and other == {"was-lab", "none"}


def test_empty_and_absent_address_parts_are_one_location(workspace):
    ws = workspace(
        {
            "Patient": [
                patient("a", address=[{"city": "X", "state": ""}]),
                patient("b", address=[{"city": "X"}, {"city": "Y"}]),
                patient("c", address=[{"city": ""}]),
                patient("d"),
            ]
        }
    )
    places = ws.model("omop_location").collect()
    assert [(r.city, r.state, r.location_source_value) for r in places] == [("X", None, "X|||")]
    people = ws.model("omop_person").select("person_source_value", "location_id")
    located = {r[0]: r[1] for r in people.collect()}
    assert located["a"] == located["b"] == places[0].location_id
    assert located["c"] is None and located["d"] is None


def test_person(workspace):
    ws = workspace(
        {
            "Patient": [
                patient("a", gender="Male", birthDate="1980-05-06", identifier=[{"value": "M1"}]),
                patient("b", gender="x", birthDate="1980-05"),
            ]
        },
        EngineConfig(hash_person_source_value=True, person_source_value_pepper="p"),
    )
    got = by(ws.model("omop_person"), "gender_source_value")
    a, b = got["Male"], got["x"]
    assert (a.gender_concept_id, a.year_of_birth, a.month_of_birth, a.day_of_birth) == (8507, 1980, 5, 6)
    assert (b.gender_concept_id, b.year_of_birth, b.race_concept_id) == (0, None, 0)
    assert len(a.person_source_value) == len(b.person_source_value) == 64


def facts(workspace, *observations, **kwargs):
    return workspace(
        {
            "Patient": [patient("p")],
            "Encounter": [
                resource("Encounter", "e", subject={"reference": "Patient/p"}, period={"start": UPDATED}, **{"class": {"code": "imp"}}),
                resource("Encounter", "lost", subject={"reference": "Patient/nobody"}, period={"start": UPDATED}),
            ],
            "Specimen": [
                resource("Specimen", "s", subject={"reference": "http://h/Patient/p"}, type={"coding": [{"system": "http://snomed.info/sct", "code": "blood"}]})
            ],
            "DiagnosticReport": [
                resource("DiagnosticReport", key, subject={"reference": "Patient/p"}, effectiveDateTime=UPDATED, result=[{"reference": "Observation/o"}, {"display": "no reference"}])
                for key in ("r1", "r2")
            ],
            "Observation": list(observations),
        },
        **kwargs,
    )


def test_measurement(workspace, spark):
    ws = facts(
        workspace,
        observation(
            "o",
            code=loinc("1-1"),
            valueQuantity={"value": 5.50, "comparator": "<", "unit": "mg/dl", "code": "MG/DL"},
            referenceRange=[{"low": {"value": "1"}, "high": {"value": 2}}],
            encounter={"reference": "Encounter/e"},
            specimen={"reference": "Specimen/s"},
        ),
    )
    rows = ws.model("omop_measurement").collect()
    # Both unit seeds spell mg/dl alike, and two reports list the observation: still one row.
    assert len(rows) == 1
    row = rows[0]
    ids = spark.createDataFrame([("o", "p", "e", "s", "r1", "r2")], "o string, p string, e string, s string, r1 string, r2 string")
    o, p, e, s, r1, r2 = ids.select(*[surrogate_key(F.col(c)) for c in ids.columns]).first()
    assert (row.measurement_id, row.person_id, row.visit_occurrence_id, row.specimen_id) == (o, p, e, s)
    assert row.visit_detail_id == min(r1, r2)
    assert (row.measurement_concept_id, row.measurement_source_concept_id, row.unit_concept_id) == (100, 100, 8840)
    assert (row.operator_concept_id, row.value_as_number, row.value_source_value) == (4171756, Decimal("5.5"), "5.5")
    assert (row.range_low, row.range_high, row.measurement_type_concept_id) == (1, 2, 32856)
    assert row.measurement_date == dt.date(2024, 1, 1)


def test_marts_keyed_by_fingerprints_differ_in_their_ids_only(workspace):
    """Ids equal the fingerprints of their sources and join as before."""
    resources = {
        "Patient": [patient("p", address=[{"city": "Cork"}]), patient("p" * 70)],
        "Encounter": [resource("Encounter", "e", subject={"reference": "Patient/p"})],
        "Observation": [observation("o", encounter={"reference": "Encounter/e"}), observation("q", "Patient/" + "p" * 70), observation("r", "Patient/x")],
    }
    plain, farm = workspace(resources), workspace(resources, EngineConfig(key_hash="farm"))
    sources = {"person_id": "person_source_value", "location_id": "location_source_value", "visit_occurrence_id": "visit_source_value"}
    for name in ("omop_person", "omop_location", "omop_visit_occurrence"):
        found = farm.model(name)
        key = found.columns[0]
        assert found.filter(F.col(key) != fingerprint64(F.col(sources[key]))).isEmpty() and not found.isEmpty()
    rows = farm.model("omop_measurement").join(farm.model("omop_person").select("person_id", "person_source_value"), "person_id")
    joined = {r.measurement_id: r for r in rows.collect()}
    ids = farm.spark.createDataFrame([("o",), ("q",), ("e",)], "t string").select("t", fingerprint64(F.col("t")).alias("id"))
    o, q, e = [dict(ids.collect())[t] for t in "oqe"]
    assert set(joined) == {o, q} and joined[o].visit_occurrence_id == e and joined[q].person_source_value == "p" * 70
    keys = ("measurement_id", "person_id", "visit_occurrence_id")
    one, two = [ws.model("omop_measurement").drop(*keys) for ws in (plain, farm)]
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_an_unknown_key_hash_is_refused():
    with pytest.raises(ValueError, match="key_hash"):
        surrogate_key(F.lit("x"), EngineConfig(key_hash="crc"))


def test_concept_fallbacks(workspace, spark):
    seed = spark.createDataFrame([("T1", "URN:local", 555, 0, ""), ("T2", "urn:local", 556, 777, "")], seeds.TEST_SEED)
    local = lambda code: {"coding": [{"system": "urn:LOCAL", "code": code}]}
    ws = facts(
        workspace,
        observation("maps", code=loinc("1-2")),
        observation("two", code=loinc("3-1")),
        observation("seeded", code=local("T1")),
        observation("seeded-source", code=local("T2")),
        observation("unknown", code=local("T9"), valueQuantity={"value": 1, "comparator": "ad", "unit": "furlong"}),
        seeds={"test": seed},
    )
    got = {
        r.measurement_source_value: r
        for r in ws.model("omop_measurement").collect()
    }
    assert got["1-2"].measurement_concept_id == 100 and got["1-2"].measurement_source_concept_id == 101
    assert got["3-1"].measurement_concept_id == 100
    assert (got["T1"].measurement_concept_id, got["T1"].measurement_source_concept_id) == (555, 0)
    assert (got["T2"].measurement_concept_id, got["T2"].measurement_source_concept_id) == (556, 777)
    lost = got["T9"]
    assert (lost.measurement_concept_id, lost.unit_concept_id, lost.operator_concept_id) == (0, 0, None)


def test_values_and_missing_links(workspace):
    ws = facts(
        workspace,
        observation("c", valueCodeableConcept={"coding": [{"system": "http://snomed.info/sct", "code": "pos", "display": "Positive"}]}, encounter={"reference": "Encounter/lost"}),
        observation("s", valueString="trace", effectiveDateTime="2024-01", effectivePeriod={"start": "2024-03-01T23:30:00-03:00"}),
        observation("orphan", subject="Patient/nobody"),
        observation("none", subject="Patient/"),
    )
    got = by(ws.model("omop_measurement"), "value_source_value")
    assert set(got) == {"Positive", "trace"}
    assert got["Positive"].value_as_concept_id == 200 and got["Positive"].visit_occurrence_id is None
    assert got["trace"].measurement_date == dt.date(2024, 3, 2)


def test_observation_and_visits(workspace):
    ws = facts(
        workspace,
        observation("v", category="vital-signs", code={"coding": [{"system": "http://snomed.info/sct", "code": "pos"}]}, valueQuantity={"value": 5}),
    )
    row = ws.model("omop_observation").first()
    assert (row.observation_concept_id, row.value_source_value, row.observation_source_concept_id) == (200, "5", 200)
    visits = ws.model("omop_visit_occurrence").collect()
    assert [(v.visit_source_value, v.visit_concept_id, v.visit_end_date) for v in visits] == [("e", 9201, dt.date(2024, 1, 1))]
    assert ws.model("omop_visit_detail").count() == 2
    specimen = ws.model("omop_specimen").first()
    assert (specimen.specimen_concept_id, specimen.anatomic_site_concept_id, specimen.specimen_date) == (201, 0, None)


def test_fact_relationship_has_both_directions(workspace):
    ws = facts(workspace, observation("o", specimen={"reference": "Specimen/s"}), observation("x"))
    rows = {(r[0], r[2], r[4]) for r in ws.model("omop_fact_relationship").collect()}
    assert rows == {(21, 36, 32676), (36, 21, 32677)}


@pytest.mark.parametrize("limit", [0, 10**6])
def test_broadcast_and_shuffled_lookups_agree(workspace, limit):
    ws = facts(
        workspace,
        *[observation(f"o{i}", code=loinc("1-1" if i % 3 else "2-1"), valueQuantity={"value": i, "code": "mg/dL"}) for i in range(9)],
        config=EngineConfig(broadcast_row_limit=limit, salt_buckets=4),
    )
    plan = ws.model("omop_measurement")._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit > 0)
    rows = ws.model("omop_measurement").groupBy("measurement_concept_id", "unit_concept_id").count().collect()
    assert {tuple(r) for r in rows} == {(100, 8840, 6), (102, 8840, 3)}


def test_incremental_filter_before_and_after_the_newest_version(workspace):
    new = "2024-03-01T00:00:00Z"
    ws = facts(
        workspace,
        observation("stays"),
        observation("moves", valueString="old"),
        observation("moves", updated=new, valueString="new"),
        observation("leaves-lab"),
        observation("leaves-lab", category="vital-signs", updated=new),
    )
    mark = F.lit("2024-03-01 00:00:00").cast("timestamp")
    pushed = measurement_since(ws, mark).select("measurement_id", "value_source_value")
    whole = ws.model("omop_measurement").filter(F.col("_loaded_at") >= mark).select("measurement_id", "value_source_value")
    assert sorted(pushed.collect()) == sorted(whole.collect())
    assert [r.value_source_value for r in pushed.collect()] == ["new"]


def test_inventory(workspace):
    ws = facts(workspace, observation("a", code=loinc("1-1")), observation("b", code=loinc("1-1")), observation("c", code=loinc("9-9")), observation("d"))
    got = by(analyses.inventory_source_codes(ws), "resolution")
    assert (got["LOINC"].n_distinct_codes, got["LOINC"].n_rows, got["LOINC"].pct_rows) == (1, 2, 50.0)
    assert (got["NEEDS_MAPPING"].n_distinct_codes, got["NEEDS_MAPPING"].n_rows) == (2, 2)


def test_lookup_codes_are_unique(workspace):
    ws = facts(workspace)
    assert ws.model("loinc_lookup").filter("concept_code = '3-1'").count() == 2
    assert codes(ws.model("loinc_lookup")).filter("code = '3-1'").collect()[0].concept_id == 100
