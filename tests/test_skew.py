"""A third of all rows under one key (missing patient ids hash to md5('')):
results equal a brute-force computation in plain Python."""

import datetime as dt
import hashlib
from collections import defaultdict

from vaxmart.operators.dims import build_patients
from vaxmart.operators.staging import build_staging
from vaxmart.plans import analytics
from vaxmart.plans.star import build_star
from vaxmart.schemas import RAW_POPULATION, RAW_VACCINATIONS

from .test_operators import raw_row

EMPTY_MD5 = hashlib.md5(b"").hexdigest()


def _rows():
    rows = []
    for i in range(300):
        pid = None if i % 3 == 0 else f"p{i % 40}"
        day = dt.date(2021, 5, 1) + dt.timedelta(days=i % 60)
        rows.append(raw_row(
            document_id=f"d{i}", paciente_id=pid, paciente_idade=i % 90,
            vacina_dataAplicacao=f"{day.isoformat()}T00:00:00.000Z",
            vacina_descricao_dose="1ª Dose" if i % 2 else "2ª Dose",
            vacina_nome="Coronavac-Sinovac/Butantan", vacina_codigo="85",
            estabelecimento_uf="SC",
        ))
    return rows


def test_hot_key_dimension_and_late_dose(spark):
    rows = _rows()
    raw = spark.createDataFrame(rows, RAW_VACCINATIONS)
    pop = spark.createDataFrame([("SC", 42, 1200010, "A", 1000)], RAW_POPULATION)
    star = build_star(raw, pop)

    patients = {r.patient_sk: r.patient_age for r in build_patients(build_staging(raw)).collect()}
    ages = defaultdict(int)
    names = [f.name for f in RAW_VACCINATIONS.fields]
    for r in rows:
        rec = dict(zip(names, r))
        key = hashlib.md5((rec["paciente_id"] or "").encode()).hexdigest()
        ages[key] = max(ages[key], rec["paciente_idade"])
    assert patients == dict(ages)
    assert EMPTY_MD5 in patients

    as_of = dt.date(2021, 8, 30)
    got = {r.category: r.unique_patients_count
           for r in analytics.late_second_dose(star.fact, star.vaccines, as_of=as_of).collect()}
    per = defaultdict(list)
    for r in rows:
        rec = dict(zip(names, r))
        day = dt.date.fromisoformat(rec["vacina_dataAplicacao"][:10])
        monday = lambda d: d - dt.timedelta(days=d.weekday())
        late = (monday(as_of) - monday(day)).days // 7 >= 5 and rec["vacina_descricao_dose"] == "1ª Dose"
        per[hashlib.md5((rec["paciente_id"] or "").encode()).hexdigest()].append(late)
    want = {
        "All patients": len(per),
        "Already took 2 doses ": sum(1 for v in per.values() if len(v) > 1),
        "Late to take 2nd dose": sum(1 for v in per.values() if len(v) == 1 and v[0]),
    }
    assert got == want
