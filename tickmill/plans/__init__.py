"""tickmill.plans"""
