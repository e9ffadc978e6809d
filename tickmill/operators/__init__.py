"""tickmill.operators"""
