"""tallywell.plans"""
