"""Invented reports: a generator of days, their rendering as lines, cells and workbooks, and cases of malformed reports."""
