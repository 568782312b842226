"""tallywell.operators"""
