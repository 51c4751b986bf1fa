import sys
import weakref

import pytest

from tidemill.llm.common import forget, remembered


class Thing:
    pass


@pytest.fixture(autouse=True)
def own_place(monkeypatch):
    monkeypatch.delitem(sys.modules, "_tidemill_worker", raising=False)
    yield
    sys.modules.pop("_tidemill_worker", None)


def test_a_worker_keeps_an_object_while_its_key_stays():
    first = remembered("one", 1, Thing)
    assert remembered("one", 1, Thing) is first
    assert remembered("one", 2, Thing) is not first


def test_a_worker_lets_go_of_an_earlier_steps_object():
    gone = weakref.ref(remembered("one", 1, Thing))
    held = []
    remembered("two", 1, lambda: held.append(gone()) or Thing())
    assert held == [None] and gone() is None
    gone = weakref.ref(remembered("two", 1, Thing))
    forget()
    assert gone() is None
    forget()
