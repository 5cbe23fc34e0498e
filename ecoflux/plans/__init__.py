"""ecoflux.plans"""
