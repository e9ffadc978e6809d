"""tickmill.streaming"""
