"""Lazy DataFrame -> DataFrame operators: quality rules, cleaning, analyses, station flow, sequencing."""
