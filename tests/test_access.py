from helpers import rows, ts

from tradewind.operators import checks
from tradewind.operators.access import authorise
from tradewind.plans.accounts import new_accounts, registration_outcomes, sessionise_logins

SESSIONS = "session_token string, user_id long, session_start timestamp, session_end timestamp"
USERS = "user_id long, user_login string, user_role string"


def test_statuses(spark):
    sessions = spark.createDataFrame([("a", 1, ts(1), None), ("b", 2, ts(1), ts(2)), ("c", 3, ts(1), None)], SESSIONS)
    users = spark.createDataFrame([(1, "x", "customer"), (2, "y", "seller")], USERS)
    requests = spark.createDataFrame([(1, "a", "customer"), (2, "a", "seller"), (3, "b", "seller"), (4, "c", "seller"),
                                      (5, "?", "seller"), (6, None, "customer"), (7, "a", "customer")],
                                     "request_id long, session_token string, needed_role string")
    got = authorise(requests, sessions, users)
    assert rows(got, "request_id", "status") == [(1, 200), (2, 403), (3, 200), (4, 404), (5, 401), (6, 401), (7, 200)]
    active = authorise(requests, sessions, users, active_only=True)
    assert rows(active.where("status = 200"), "request_id") == [(1,), (7,)]


REQUEST = "request_id long, username string, user_role string, created_at timestamp"


def test_first_valid_registration_wins(spark):
    requests = spark.createDataFrame([
        (1, "n", "admin", ts(1)), (2, "n", "seller", ts(2)), (3, "n", "customer", ts(3)), (4, "old", "seller", ts(1)),
        (5, "m", "customer", ts(5)), (6, "m", "customer", ts(5)), (7, "z", None, ts(1))], REQUEST)
    users = spark.createDataFrame([(1, "old", "seller")], USERS)
    outcomes = registration_outcomes(requests, users)
    assert rows(outcomes, "request_id", "outcome") == [
        (1, "bad_role"), (2, "registered"), (3, "duplicate"), (4, "duplicate"), (5, "registered"), (6, "duplicate"), (7, "bad_role")]
    taken = spark.createDataFrame([("m",)], "username string")
    added = new_accounts(outcomes, {"customers": taken, "sellers": taken})
    assert rows(added["customers"]) == [] and rows(added["sellers"], "username") == [("n",)]


def test_sessions_from_a_log(spark):
    log = spark.createDataFrame([("a", 1, "login", ts(1)), ("a", 1, "login", ts(2)), ("a", 1, "logout", ts(3)),
                                 ("b", 2, "login", ts(4)), ("c", 3, "logout", ts(5))],
                                "session_token string, user_id long, action string, ts timestamp")
    assert rows(sessionise_logins(log)) == [("a", 1, ts(1), ts(3)), ("b", 2, ts(4), None)]


def test_constraint_reports(spark):
    users = spark.createDataFrame([(1, "x", "customer"), (2, "x", None), (3, "x", "seller"), (4, None, "seller"), (5, None, None)], USERS)
    sessions = spark.createDataFrame([("a", 1), ("b", 9), ("c", 9), ("d", None)], "session_token string, user_id long")
    got = dict(rows(checks.report(
        checks.unique_check(users, "users", "user_login"),
        checks.not_null_checks(users, "users", ["user_login", "user_role"]),
        checks.foreign_key_check(sessions, "sessions", "user_id", users, "users"),
        checks.text_length_check(users, "users", "user_role", 6))))
    assert got == {"users.user_login unique": 2, "users.user_login not null": 2, "users.user_role not null": 2,
                   "sessions.user_id references users": 2, "users.user_role length <= 6": 1}
    assert rows(checks.unique_check(users.where("false"), "users", "user_login")) == [("users.user_login unique", 0)]
