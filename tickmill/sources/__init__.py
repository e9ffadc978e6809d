"""tickmill.sources"""
