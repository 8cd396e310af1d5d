"""Stages that read and write tables, built from the operators."""
