import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from cauce.session import build_session, checkpoint_root

    s = build_session("local[4]", app_name="cauce-tests", shuffle_partitions=4)
    checkpoint_root(s)  # sets a local checkpoint dir only when the session has none
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="cauce-test-")


def write_text(path: str, text: str, encoding: str = "latin1") -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


# Inputs in the shape of the official exports (income, crime with preamble, call centre)
RENTA_CSV = (
    "Municipios;Indicadores de renta media y mediana;Periodo;Total\n"
    "42020 Losilla, La;Renta neta media por persona;2018;9.870\n"
    "42020 Losilla, La;Renta neta media por persona;2021;12.406\n"
    "42134 Ólvega;Renta neta media por persona;2021;18.055\n"
)
DELITOS_CSV = (
    "Infracciones penales por municipio\n"
    "Segundo trimestre\n"
    "Fuente: elaboración propia\n"
    "Municipio;2020;2021\n"
    "SORIA (PROVINCIA DE);41;57\n"
    "ÁGREDA;6;4\n"
    "COVALEDA;3;9\n"
)
CONTACT_CSV = (
    "sessionID;DNI;Telef;CP;duration_call_mins;funnel_Q;Producto\n"
    "b's-07';;655010203;42134;4.25;Garaje;\n"
    "b's-09';D31;655040506;42020;0.5;Ático;Plan Vida\n"
    "b's-07';D18;655010203;42134;6.75;Trastero;\n"
    "b's-11';D44;655070809;42999;1;;\n"
    "b's-09';D31;655040506;42020;0.5;Garaje;\n"
    "b's-07';D18;655010203;42134;4.25;Garaje;Plan Auto\n"
)


@pytest.fixture()
def inputs(workdir):
    from cauce.sources.layout import Layout

    data = os.path.join(workdir, "data")
    write_text(os.path.join(data, "renta_por_hogar.csv"), RENTA_CSV)
    write_text(os.path.join(data, "delitos_por_municipio.csv"), DELITOS_CSV)
    write_text(os.path.join(data, "contac_center_data.csv"), CONTACT_CSV)
    return Layout.resolve(in_root=data, out_root=os.path.join(workdir, "output"))
