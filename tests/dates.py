"""Dates and times from text, for hand-written rows."""

import datetime as dt


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)
