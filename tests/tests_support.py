"""Helpers shared by the oracle test."""

from oracle_check import compare


def compare_one(spark, sf_dir, name):
    return compare(spark, sf_dir, [name], verbose=False)[name]
