import pytest

from corpusloom.operators.gateway import CallError, Policy, Registry, complete


def test_retry_then_fallback():
    seen = []

    def call(target, prompt):
        seen.append(target)
        if target == "a":
            raise CallError("rate_limit")
        return prompt

    assert complete(call, ["a", "b"], "x", Policy(attempts=2)) == ("x", [("a", 1, "rate_limit"), ("a", 2, "rate_limit"), ("b", 1, "success")])
    assert seen == ["a", "a", "b"]


def test_invalid_requests_stop():
    def call(target, prompt):
        raise CallError("invalid_request")

    assert complete(call, ["a", "b"], "x", Policy()) == (None, [("a", 1, "invalid_request")])


def test_quota_moves_on_without_retry():
    def call(target, prompt):
        if target == "a":
            raise CallError("quota")
        return "ok"

    assert complete(call, ["a", "b"], "x", Policy())[1] == [("a", 1, "quota"), ("b", 1, "success")]


def test_invalid_answers_obey_the_switch():
    tried = complete(lambda t, p: t, ["a", "b"], "x", Policy(attempts=1, fallback_on_invalid=False), lambda p, a: a == "b")
    assert tried == (None, [("a", 1, "response_format")])
    assert complete(lambda t, p: t, ["a", "b"], "x", Policy(attempts=1), lambda p, a: a == "b")[0] == "b"


def test_delay_and_registry():
    p = Policy(first_ms=100, most_ms=250)
    assert [p.delay_ms(i, None) for i in (1, 2, 3)] == [100, 200, 250] and p.delay_ms(1, 9000) == 250
    r = Registry()
    r.register("x", len)
    assert r.pick("x") is len
    with pytest.raises(KeyError):
        r.pick("y")
