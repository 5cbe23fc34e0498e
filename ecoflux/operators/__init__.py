"""ecoflux.operators"""
