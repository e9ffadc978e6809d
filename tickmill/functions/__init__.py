"""tickmill.functions"""
