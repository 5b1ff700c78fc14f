from eventlake.config import SessionConfig
from eventlake.operators import sessions
from eventlake.plans import models
from tests.conftest import PURCHASE, at


def test_recommendations_stay_with_like_minded_buyers(events):
    rows = []
    for user in range(1, 21):
        side = "A" if user <= 10 else "B"
        # Each user has bought all but one product of their side.
        rows += [
            {**PURCHASE, "user_id": user, "product_id": f"{side}{n}"} for n in range(8) if n != user % 8
        ] * 2
    got = models.recommendations(events(*rows), top=8, rank=2).collect()
    for user in range(1, 21):
        mine = sorted((r for r in got if r["user_id"] == user), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 9))
        side = "A" if user <= 10 else "B"
        assert all(r["product_id"].startswith(side) for r in mine)


def test_segments_split_small_and_large_buyers(events):
    rows = []
    for user in range(1, 21):
        big = user > 10
        rows += [{**PURCHASE, "user_id": user, "price": 400.0 if big else 5.0 + user}] * (9 if big else 1)
    got = {r["user_id"]: r["segment"] for r in models.customer_segments(events(*rows), k=2).collect()}
    assert len({got[u] for u in range(1, 11)}) == 1 and len({got[u] for u in range(11, 21)}) == 1
    assert got[1] != got[20]


def test_carts_raise_the_conversion_score(events):
    rows = []
    for user in range(1, 41):
        if user % 2:
            rows += [{"user_id": user, "event_type": "add_to_cart"}, {**PURCHASE, "user_id": user, "event_timestamp": at(3)}]
        else:
            rows += [{"user_id": user}, {"user_id": user, "event_timestamp": at(3)}]
    table = sessions.sessions(events(*rows), SessionConfig())
    got = models.conversion_scores(table).collect()
    assert len(got) == 40
    assert min(r["conversion_probability"] for r in got if r["converted"]) > max(
        r["conversion_probability"] for r in got if not r["converted"]
    )
